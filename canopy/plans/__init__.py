"""Fixture mappings of the provided tables, the registered queries and their DuckDB oracles."""
