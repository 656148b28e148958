"""Training-data operators: scoring, filtering, deduplication, mixing, packing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
