"""Retail analytics on Spark: cleaning, star schema, marts, statistics, streaming merge and models."""
