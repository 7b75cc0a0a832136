"""Threshold-and-persistence risk monitoring over time series, as Spark DataFrame jobs."""
