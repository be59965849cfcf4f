"""Operators for text corpora: filters, deduplication, decontamination, classifiers, tokens."""
