"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from rostrum.plans import formats, language, pages, records, relational, scalars, searching  # noqa: F401
from rostrum.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
