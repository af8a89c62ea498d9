"""Operators: functions that take DataFrames and return DataFrames."""
