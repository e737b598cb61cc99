"""Operators of a training-data pipeline: one module each, over `documents`, `pages`, `benchmark` and `labels`."""
