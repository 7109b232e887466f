"""Operators: monthly fact table, marts, dashboard datasets, data-quality reports."""
