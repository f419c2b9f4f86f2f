"""Registered queries over the provided tables, each with its DuckDB counterpart."""
