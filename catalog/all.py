"""Importing this module fills the registry."""

from catalog import generation, quality, review, sampling, sources, text, training  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
