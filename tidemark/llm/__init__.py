"""Operators for building training data: tokens, language, duplicates, packing, search.

Nothing outside this folder imports it. `queries` registers one query per operator.
"""
