"""Operators for preparing training text, and the queries that apply them.

Nothing else in the library imports this subpackage; ``registry`` lists its
queries. The modules import nothing heavy here, so a Python worker that needs
one operator loads only that one.
"""
