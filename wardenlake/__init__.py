"""Scoring and monitoring of rare-event classifiers on Spark tables and streams."""
