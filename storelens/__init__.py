"""Retail analytics on Spark: feeds in, department KPIs out."""
