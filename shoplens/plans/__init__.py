"""Whole jobs composed of operators: ingestion, the reports, the findings record."""
