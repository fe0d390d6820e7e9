"""Operators over DataFrames: newest rows, joins, widening, shaping, checks."""
