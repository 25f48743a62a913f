"""All registered queries of the panel operators."""

from __future__ import annotations

from . import checks, extraction, panels, statistics  # noqa: F401
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
