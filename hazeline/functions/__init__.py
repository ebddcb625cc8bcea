"""Column-level building blocks: each takes Columns and gives a Column."""
