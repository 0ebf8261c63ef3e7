"""Operators that prepare training data: one module per operator, with its registered query.

Nothing else in the package imports this one; ``registry.py`` here lists its queries.
"""
