"""Operators for preparing text corpora: scans, deduplication, scoring, encoding and packing."""
