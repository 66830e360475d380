"""Operators for large text corpora: repeats, tokens, packing, near copies, archives, search, PII, quality."""
