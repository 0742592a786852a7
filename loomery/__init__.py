"""Spark-first dataset curation engine."""
