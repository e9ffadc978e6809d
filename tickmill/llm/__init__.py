"""Operators of a training-data pipeline over documents, pages and benchmarks.

Nothing outside this subpackage imports it. Every operator is a function on
DataFrames in a module of its own; ``queries`` holds the registered queries.
"""
