"""Operators: functions from DataFrame to DataFrame over messages, tiles or cells."""
