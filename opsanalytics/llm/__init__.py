"""Operators for building training corpora; each module holds one operator and its registered query.

Nothing outside this subpackage imports it.  ``catalogue()`` returns the queries
and their SQL twins.
"""
