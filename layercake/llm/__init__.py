"""Operators for large-scale training-data preparation.

Nothing else in the library imports this package. Every operator takes
DataFrames plus column names, reads only the columns it names (extra columns,
whatever they are called, never clash) and returns a DataFrame; ``queries``
binds the operators to the ``documents`` / ``pages`` / ``embeddings`` tables.
"""
