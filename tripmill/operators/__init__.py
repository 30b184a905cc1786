"""Operators over trip DataFrames."""
