"""Spark-first building blocks for unifying messy open data into audited tables."""
