"""Operators of a training-data pipeline.

One module per operator; nothing outside this package imports it.  Every
operator takes and returns DataFrames, selects the columns it needs by name
(extra columns never clash) and states its edge cases in its docstring.
"""
