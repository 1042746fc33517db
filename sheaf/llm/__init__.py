"""Operators for training-data pipelines: filters, duplicates, scores and mixes over whole corpora of documents."""
