"""Relational and time-series operators for datasets of people tracked in video, on Spark."""
