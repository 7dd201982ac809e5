"""Outbreak analytics on Spark: weather observations in, case forecasts out."""
