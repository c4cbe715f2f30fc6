"""Sinks: CSV, JSON and Parquet outputs and the record form of alerts."""
