"""All queries of the change-data operators, with the SQL of the same rows."""

from __future__ import annotations

from tidelog.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
