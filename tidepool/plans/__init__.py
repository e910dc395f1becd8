"""Data jobs and the query registry."""
