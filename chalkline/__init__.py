"""Chalkline: multi-district education analytics as Spark DataFrame jobs."""
