"""Operators from DataFrame to DataFrame; every one takes its column names as parameters."""
