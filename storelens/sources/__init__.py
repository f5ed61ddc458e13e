"""Readers: tables, Parquet, landing files, notifications, record streams."""
