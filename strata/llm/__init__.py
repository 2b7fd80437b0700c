"""Operators for large-scale training-data pipelines (text, tokens, vectors).

Nothing else in the library imports this subpackage.
"""
