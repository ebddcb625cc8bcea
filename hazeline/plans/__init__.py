"""Whole reports and the staging of tables that several results share."""
