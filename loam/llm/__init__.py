"""Operators of a training-data pipeline, one module per operator.

``queries.QUERIES`` holds the registered queries, ``queries.ORACLE`` their SQL.
Nothing else in the library imports this subpackage.
"""
