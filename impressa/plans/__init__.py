"""Registered queries, one module per group."""

from impressa.plans import modelling, relational, roundtrips, sampling, scoring, sketching, textual  # noqa: F401
from impressa.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
