"""Operators: functions from DataFrames to DataFrames over many snapshots at once."""
