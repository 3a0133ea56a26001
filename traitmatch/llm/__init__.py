"""Operators for large-scale text corpora (tokenising, filtering, deduplication, audits).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
