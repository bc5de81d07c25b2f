"""Queries on the driver tables with the SQL that states the same result."""
