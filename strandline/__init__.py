"""Strandline: a lakehouse flow and its measures, written as plain Spark DataFrame jobs."""
