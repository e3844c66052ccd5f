"""Operators for building training data: formatting, encoding, packing, filtering, scoring, search and joins."""
