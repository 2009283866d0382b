"""Marketplace stream analytics as Spark DataFrame and Structured Streaming transforms."""
