"""Windowed aggregates over event streams, and how to run them."""
