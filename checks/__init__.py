"""Queries over the driver's tables and the DuckDB statements they have to agree with."""
