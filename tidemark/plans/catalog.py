"""Imports every query module, so that the registry is complete."""

from tidemark.plans import (  # noqa: F401
    analytics,
    metrics,
    models,
    routing,
    streams,
    tables,
)
from tidemark.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
