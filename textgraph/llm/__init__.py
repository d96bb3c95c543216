"""Operators of a training-data pipeline: classifiers, sketches, near
duplicates, packing, language-model scores, mixing, sharding, URL filters.

``queries`` registers one query per operator; nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
