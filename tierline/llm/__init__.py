"""Operators of a training-data pipeline over text, vectors and conversations.

Nothing else in the library imports this subpackage.
"""
