"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it; the
registered queries are in :mod:`tidemark.llm.queries`, their DuckDB
counterparts in :mod:`tidemark.llm.oracle`.
"""
