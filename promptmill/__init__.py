"""Spark jobs that prepare, pack and score language-model fine-tuning data."""
