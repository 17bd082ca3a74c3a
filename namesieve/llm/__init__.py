"""Operators of a training-data pipeline: scoring, extraction, archives, privacy, duplicates, packing, mixing, search, quality, language."""
