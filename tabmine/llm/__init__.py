"""Operators for preparing training corpora, one module each.

Every operator takes and returns DataFrames, states its edge cases in its
docstring and keeps its own interface; ``queries`` holds the thin registered
queries. Nothing else in the library imports this package.
"""
