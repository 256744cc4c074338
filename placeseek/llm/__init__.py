"""Operators for preparing language-model training data.

One module per operator, each usable by itself; ``queries`` registers one
query per operator and ``corpus_pipeline.py`` at the repository top chains
five of them.  Nothing outside this subpackage imports it but the guarded
lines of ``__spark_entry__.py``.
"""
