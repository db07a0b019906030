"""Registered queries: operators bound to the driver tables."""

from tableloom.plans import cleaning, events, relational, text, warehouse  # noqa: F401
from tableloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
