"""Operators of a training-data pipeline, each from frames to frames."""
