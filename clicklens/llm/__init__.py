"""Operators for preparing training text: each module is one operator.

Nothing else in the library imports this package. ``queries.QUERIES`` holds
the registered queries; the modules' functions are the general interface.
"""
