"""Operators: functions from tables to tables."""
