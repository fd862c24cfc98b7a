"""Operators of a training-data pipeline: cleaning, de-duplication, filtering, packing."""
