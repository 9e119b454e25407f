"""Corpus operators for training-data pipelines: quality rules, language
identification, decontamination, sharding, personal data, token roll-ups,
source mixing, page text, exact-substring and near-duplicate removal.

Nothing outside this subpackage (and corpus_pipeline.py) imports it.
"""
