"""Operators of a training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it; the
driver contract adds its queries only if it can be imported.
"""
