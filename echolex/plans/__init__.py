"""Composed jobs: scoring, daily report, read model."""
