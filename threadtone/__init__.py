"""Sentiment statistics over discussion comments, as Spark jobs."""

from threadtone.operators.classifier import Target

__all__ = ["Target"]
