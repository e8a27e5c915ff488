"""Operators for preparing training text at scale.

Each module holds one operator with its own interface; :mod:`kerbline.llm.queries`
binds them to the tables of a data folder.  Nothing outside this package imports it.
"""
