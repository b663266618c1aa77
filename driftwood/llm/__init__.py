"""Operators for preparing text corpora, each a function over DataFrames.

One module holds one operator; ``queries`` registers the thin query of each.
Nothing else in the library imports this package.
"""
