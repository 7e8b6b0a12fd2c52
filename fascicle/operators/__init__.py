"""Relational and text operators: functions from DataFrames to a DataFrame."""
