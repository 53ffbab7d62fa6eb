"""Retail sales warehouse on Spark: staging, star schema, marts and report data sets."""
