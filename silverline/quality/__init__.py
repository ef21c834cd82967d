"""Expectations, metrics, profiling and key discovery."""
