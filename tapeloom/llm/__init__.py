"""Operators for building language-model training data: the ten dealt components and their queries.

Nothing outside this folder imports it, so it can be removed whole.
"""
