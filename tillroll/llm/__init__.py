"""Operators of a training-data pipeline over the text tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
