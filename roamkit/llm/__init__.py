"""Operators for large training-data pipelines (text, tokens, web archives).

Nothing outside this package imports it.  Queries and their SQL are in
``roamkit.llm.queries``; the chained stages are in ``corpus_pipeline.py``.
"""
