"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; ``registry.py`` applies each one, with its
production parameters, to its whole table.
"""
