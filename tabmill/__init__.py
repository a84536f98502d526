"""Tabular machine learning on Spark: every operator takes and returns DataFrames."""
