"""Registered queries: the library applied to receivables derived from the test tables."""

from . import receivables, relational, scalars, snapshots  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
