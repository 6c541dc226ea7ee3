"""Structured Streaming entry points. All transforms are the batch ones."""
