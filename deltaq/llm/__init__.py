"""Operators for building training corpora: token counts, toxicity, search, PII, near-duplicates,
mixing, licence scans, token files and packing.  Nothing outside this package imports it."""
