"""Composed plans: the end-to-end flows (ingest, analysis) as single lazy Spark plans."""
