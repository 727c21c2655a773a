"""Operators of a training-data pipeline: text, web pages, archives and binary codes.

Nothing else in the library imports this subpackage.
"""
