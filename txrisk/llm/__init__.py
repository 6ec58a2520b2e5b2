"""Operators of a large-scale training-data pipeline. Nothing outside this
subpackage (and the top-level ``corpus_pipeline``) imports it."""
