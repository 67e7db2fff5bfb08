"""Lazy plans from landed sources to answers: DataFrames in, DataFrame out."""
