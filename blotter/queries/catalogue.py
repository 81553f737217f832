"""All registered queries and their checking SQL."""

from __future__ import annotations

from blotter.queries import features, ingestion, models, rows, streams  # noqa: F401  (registers)
from blotter.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
