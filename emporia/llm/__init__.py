"""Operators for preparing language-model training data.

Each module holds one operator as functions from DataFrames to DataFrames.
``queries.py`` registers one query per operator; nothing outside this
subpackage imports it except ``__spark_entry__.py`` (guarded) and
``corpus_pipeline.py``.
"""
