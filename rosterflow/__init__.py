"""Recruitment and training records as Spark DataFrame jobs."""
