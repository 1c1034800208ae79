"""Operators of a training-data pipeline (filtering, scoring, deduplication,
mixing).  Nothing outside this package imports it."""
