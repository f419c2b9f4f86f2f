"""Operators for preparing training corpora. Nothing outside this package imports it but the query entry."""
