"""Relational operators over facts, values and readings: DataFrames in, DataFrames out."""
