"""Operators: functions from DataFrames to DataFrames, composed lazily."""
