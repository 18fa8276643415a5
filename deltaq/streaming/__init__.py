"""Structured Streaming: the per-batch normaliser and the changes / join / running queries."""
