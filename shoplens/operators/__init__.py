"""Operators over one or two tables; every one returns a DataFrame and starts no job."""
