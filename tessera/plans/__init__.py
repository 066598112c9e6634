"""The registered queries."""

from tessera.plans import linkage, profiles
from tessera.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "linkage", "profiles"]
