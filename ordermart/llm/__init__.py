"""Operators for preparing language-model training data, each on plain Spark DataFrames.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
