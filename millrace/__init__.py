"""Layered ELT, change capture and data quality on Spark DataFrames."""
