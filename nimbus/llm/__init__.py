"""Operators of a training-data pipeline (text in, decisions and files out).

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries.py`` binds them to the tables.
"""
