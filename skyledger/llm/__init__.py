"""Operators that prepare text corpora for training: filters, duplicates, tokens, archives."""
