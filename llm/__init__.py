"""Operators for preparing training data, each a Spark job of its own.

Nothing else in the repository imports this subpackage.  ``queries.py`` lists
the registered queries; ``README.md`` of the repository describes the methods.
"""
