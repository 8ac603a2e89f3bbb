"""Operators for training-data pipelines: the ten numbered ones and their queries."""
