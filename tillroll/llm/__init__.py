"""Operators of a training-data pipeline: language id, decontamination,
near-duplicates, WARC, quality rules, secrets, pseudonyms, mixing, quality
classifier, sharding. Nothing else in the library imports this subpackage."""
