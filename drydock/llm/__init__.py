"""Operators for building training corpora.

Nothing else in the package imports this subpackage; its queries and their SQL
are in ``queries.py`` and are registered only where it can be imported.
"""
