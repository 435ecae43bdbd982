"""Registered queries over the given tables, each with its SQL twin where one exists."""

from __future__ import annotations

from zephyrine.registry import (  # noqa: F401
    checks,
    expressions,
    jobs,
    models,
    profiles,
    relations,
    scans,
    series,
    streams,
)
from zephyrine.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
