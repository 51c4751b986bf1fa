"""Operators: functions from DataFrames to a DataFrame, without hidden limits or collects."""
