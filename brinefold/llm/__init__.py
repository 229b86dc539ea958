"""Operators for preparing training corpora.

Nothing outside this folder (but for ``corpus_pipeline.py``) imports it.
"""
