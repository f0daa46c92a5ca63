"""Operators of a training-data pipeline: scans, filters, near copies, encoders and archives."""
