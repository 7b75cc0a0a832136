"""Operators put together over the tables, as named queries with their SQL."""
