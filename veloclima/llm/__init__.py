"""Operators that prepare text for training language models.

Nothing else in the library imports this package.  Each module holds one operator with a
general interface; ``queries`` derives the fixed result columns of the registered queries.
"""
