"""Spark-first analytics engine for long-read amplicon tandem duplications."""
