"""Operators that prepare text, vectors and pages for model training.

Nothing else in the package imports this subpackage.
"""
