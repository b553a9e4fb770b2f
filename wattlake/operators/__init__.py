"""Operators: functions from DataFrame to DataFrame, all lazy."""
