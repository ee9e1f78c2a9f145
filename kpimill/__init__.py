"""Reporting and KPI-load operators on Spark DataFrames."""
