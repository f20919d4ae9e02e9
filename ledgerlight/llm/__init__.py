"""Operators of a training-data pipeline: filtering, deduplication,
decontamination, mixing, formatting, archives and classifiers."""
