"""Operators: functions from DataFrames to DataFrames, keyed by match_id."""
