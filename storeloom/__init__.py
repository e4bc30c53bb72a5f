"""Retail landing, warehouse and mart jobs on Spark DataFrames."""
