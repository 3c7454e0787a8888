"""Operators for preparing large text corpora for language-model training.

Each operator is a DataFrame -> DataFrame function in a module of its own; the
registered queries are in ``queries.py`` and their SQL in ``oracle.py``.
"""
