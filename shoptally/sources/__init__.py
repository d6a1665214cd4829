"""Readers of the point-of-sale exports and writers of the result tables."""

from shoptally.sources.readers import load_table, path_exists, read_inventory, read_lines, read_sales, sniff_delimiter
from shoptally.sources.writers import write_clean, write_clusters, write_eval_report, write_features

__all__ = [
    "load_table",
    "path_exists",
    "read_inventory",
    "read_lines",
    "read_sales",
    "sniff_delimiter",
    "write_clean",
    "write_clusters",
    "write_eval_report",
    "write_features",
]
