"""All registered queries."""

from __future__ import annotations

from . import insight, labels, lifecycle, monitoring, splits, streams, tabular, text  # noqa: F401
from .base import QUERIES

__all__ = ["QUERIES"]
