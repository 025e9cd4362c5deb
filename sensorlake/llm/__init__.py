"""Operators of a training-data pipeline: language, near copies, licences,
quality, fingerprints, toxicity, packing, quality rules, shards and mixing.
Nothing else in the library imports this package."""
