"""Whole plans: the pipeline and the catalogue of queries with their SQL."""
