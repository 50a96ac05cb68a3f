"""Operators on DataFrames that Spark has no single method for."""
