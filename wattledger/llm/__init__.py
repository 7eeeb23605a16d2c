"""Operators for text corpora that are to train language models."""
