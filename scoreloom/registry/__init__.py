"""Registered queries, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from importlib import import_module

AREAS = (
    "retrieval", "text", "association", "topics", "features", "classify", "scoring", "contracts",
)


def load():
    """All registered queries and SQL twins, by operator name."""
    for area in AREAS:
        import_module(f"scoreloom.registry.{area}")
    from scoreloom.registry.base import ORACLES, QUERIES

    return QUERIES, ORACLES
