"""Composed queries: research contexts, request validation, refresh."""
