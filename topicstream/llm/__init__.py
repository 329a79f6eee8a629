"""Operators for large training corpora, one module each, on plain DataFrames."""
