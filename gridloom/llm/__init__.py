"""Operators of a training-data pipeline over the ``documents`` table.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames, treats a null text as empty and ignores columns it does not name.
"""
