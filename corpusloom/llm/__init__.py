"""Operators for preparing training data, and their registered queries.

Nothing else in the package imports this one.
"""
