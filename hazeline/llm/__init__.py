"""Operators for training data: cleaning, scoring, deduplication, tokens and packing."""
