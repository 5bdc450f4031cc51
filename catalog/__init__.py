"""Registered queries over the given tables, each with its SQL oracle where SQL can express it."""

from .registry import ORACLES, QUERIES
from . import aggregates, draws, drift, joins, metrics, models, order, projections, rules, scalars, sources, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
