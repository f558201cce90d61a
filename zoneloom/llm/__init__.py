"""Operators for training-data corpora: texts in, decisions, clean texts or batches out."""
