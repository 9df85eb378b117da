"""Verification of gridded ensemble forecasts against observations, on Spark DataFrames."""
