"""Retail stock-out analytics as functions from Spark DataFrames to DataFrames."""
