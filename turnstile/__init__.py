"""Retail attribution marts on Spark: every operator maps DataFrames to a DataFrame."""
