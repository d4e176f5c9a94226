"""Zones, feature mart and regression models on Spark DataFrames."""
