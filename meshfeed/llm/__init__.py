"""Operators for the preparation of training text, and a pipeline's stages made of them.

Nothing else in the library imports this subpackage.
"""
