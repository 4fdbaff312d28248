"""Operators for large text corpora: scoring, de-duplication, quality, packing and encoding.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries.
"""
