"""Operators of a training-data pipeline: dedup, tokenizing, packing, extraction, scoring."""
