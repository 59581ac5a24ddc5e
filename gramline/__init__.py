"""Supervised text classification as Spark jobs: ingest, clean, featurise, fit, evaluate, search, score."""
