"""Operators on gridded emission data, each a function from DataFrames (or Columns) to a DataFrame (or Column)."""
