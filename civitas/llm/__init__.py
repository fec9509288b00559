"""Operators of a training-data pipeline: licence scan, near-duplicates of
texts and vectors, toxicity, packing, URL filter, token files, suffix-array
deduplication, WARC archives and benchmark decontamination."""
