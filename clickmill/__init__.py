"""Hourly recruitment KPIs from raw tracking events, on Spark DataFrames."""
