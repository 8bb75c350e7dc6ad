"""Operators: functions from DataFrame to DataFrame, lazy, with no collect inside."""
