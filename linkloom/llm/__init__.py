"""Operators for preparing large text corpora for model training.

Nothing outside this subpackage imports it. Each operator is a plain function over
DataFrames; the thin queries that apply them to the standard tables are in ``queries``.
"""
