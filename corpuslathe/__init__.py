"""Corpus analytics on Spark: deterministic, auditable processing of text corpora as DataFrame plans."""
