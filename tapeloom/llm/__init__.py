"""Operators for preparing training data: thirteen methods, each over whole Spark tables.

Nothing outside this subpackage imports it.
"""
