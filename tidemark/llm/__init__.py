"""Operators of a training-data pipeline over documents, pages and urls.

One module per operator; ``queries`` registers the query of each over the
given tables. Nothing else in the library imports this subpackage.
"""
