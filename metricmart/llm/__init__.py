"""Operators of a training-data pipeline on Spark: mixing, deduplication, decontamination, classifiers, PII, chat and WARC."""
