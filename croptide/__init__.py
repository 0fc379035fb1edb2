"""Gridded daily weather and crop-market series on Spark DataFrames."""
