"""The given tables as measurements and registries, and every operator run on them."""
