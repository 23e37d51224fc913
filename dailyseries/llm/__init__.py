"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; the entry module adds its
queries only when it can be imported.
"""
