"""Electricity-market time series on Spark: documents, points, hourly models, checks."""
