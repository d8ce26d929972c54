"""Operators for preparing text corpora for language-model training.

Nothing outside this subpackage imports it. Its queries and their SQL are in
`queries.py` and `oracle.py`.
"""
