"""Ordered token streams to sequence-model training data, as Spark jobs."""

from seqloom.config import Settings

__all__ = ["Settings"]
