"""Spark-first analytics for equipment logs and inspection files."""
