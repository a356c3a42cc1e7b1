"""Operators for preparing large text corpora: quality, tokens, shards, near duplicates, personal data, mixing."""
