"""Lakehouse operations work as Spark DataFrame jobs."""
