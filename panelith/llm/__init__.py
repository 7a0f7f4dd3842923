"""Operators for preparing training data from text: mixing, deduplication, filtering, encoding."""
