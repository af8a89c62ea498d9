"""Supplier profiling and order forecasting on Spark DataFrames."""
