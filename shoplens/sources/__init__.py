"""Readers, writers, table schemas and the table catalog."""
