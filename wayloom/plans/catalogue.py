"""All queries of the map engine and their SQL oracles, by name."""

from __future__ import annotations

from . import analytics_queries, archive_queries, grid_queries, landmark_queries, source_queries, spatial_queries, verify_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
