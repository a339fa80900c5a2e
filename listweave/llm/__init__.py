"""Operators of a training-data pipeline, each by its own method.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""
