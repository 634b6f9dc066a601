"""Operators of a training-data pipeline: sharding, tokens, packing, duplicates, toxicity, personal data, scoring."""
