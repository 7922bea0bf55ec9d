"""All registered queries, by area."""

from . import rows, stats, tasks, texts, vectors  # noqa: F401  (registration)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
