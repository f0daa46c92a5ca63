"""Streaming counts and sinks."""
