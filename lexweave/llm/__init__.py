"""Operators for building training corpora: packing, near duplicates, quality, tokens, secrets, archives, page text."""
