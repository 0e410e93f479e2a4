"""Spark-first data plane for speech and language corpora."""
