"""Readers: message topics, catalogue and control files, metric samples, the driver's tables."""
