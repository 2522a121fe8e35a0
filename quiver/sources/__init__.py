"""Readers of landed files and the canonical series views; sinks."""
