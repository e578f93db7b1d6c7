"""Retail analytics operators for PySpark: every operator maps DataFrames and parameters to a DataFrame."""
