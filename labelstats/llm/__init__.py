"""Operators for preparing training data: text, sharding, search, archives and classifiers.

Each module holds one operator and states what it does with nulls, empty and very long
values, ties, repeated rows, empty tables and extra columns. ``queries`` registers them.
"""
