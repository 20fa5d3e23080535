"""Operators of a training-data pipeline: dedup, encoding, packing, scoring, mixing and filtering of documents."""
