"""Operators for large text corpora; nothing else in the library imports this package.

Each module holds one operator with a general interface. ``queries`` registers them over the
tables ``documents``, ``benchmark``, ``labels`` and ``pages``.
"""
