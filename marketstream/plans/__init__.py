"""Queries: operators put together over the driver's tables."""
