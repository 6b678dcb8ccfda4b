"""Operators for preparing training text: near and exact duplicates, filters, mixing, sharding, formatting.

Nothing else in the library imports this subpackage. ``queries`` holds the registered queries and their SQL.
"""
