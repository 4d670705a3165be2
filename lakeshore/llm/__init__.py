"""Operators for preparing training data: mixing, fingerprints, chat formatting, packing,
language identification, page text, token counts, set-similarity joins, top-k search, toxicity.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
