"""Imports every query module, so that the registry is complete."""

from roadlens.plans import (  # noqa: F401
    compare_queries,
    link_queries,
    performance_queries,
    profile_queries,
    speed_queries,
    transfer_queries,
)
from roadlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
