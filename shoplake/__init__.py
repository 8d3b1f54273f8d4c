"""Retail lakehouse on Spark: raw feeds, cleansed tables and a star schema."""
