"""Named queries over the driver's tables, each with the SQL that a second engine answers alike."""

from __future__ import annotations

from spillway.queries import functions, lifecycle, relational, spatial
from spillway.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "functions", "lifecycle", "relational", "spatial"]
