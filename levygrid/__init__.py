"""Jurisdiction tax-matrix engine expressed as Spark DataFrame jobs."""
