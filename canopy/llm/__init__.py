"""Operators for large text corpora, one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` holds
the registered queries and ``oracle`` their SQL.
"""
