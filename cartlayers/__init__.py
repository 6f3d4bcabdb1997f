"""Layered e-commerce analytics on Spark: raw, cleaned and business tables with quality checks."""
