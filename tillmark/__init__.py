"""Retail sales analytics as composable PySpark DataFrame functions and jobs."""
