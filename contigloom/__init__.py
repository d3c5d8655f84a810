"""Spark-first analytics for mixed-genome assembly tables."""
