"""Sinks: Parquet/JDBC marts, CSV export, JSON-lines raw zone."""
