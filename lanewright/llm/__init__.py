"""Operators that prepare text corpora: scans, scores, extraction, deduplication, tokens."""
