"""Operators: functions from DataFrame to DataFrame, with nothing collected inside."""
