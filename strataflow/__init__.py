"""Batch analytics for layered lakehouse tables, written as Spark DataFrame plans."""
