"""Operators of a training-data pipeline over text tables.

Each module holds one operator with its own interface; ``queries`` registers
one query per operator, which reads a driver table through its operator.
"""
