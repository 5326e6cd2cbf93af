"""Importing this module registers every query."""

from roadgrain.plans import (  # noqa: F401
    model_queries,
    quality_queries,
    route_queries,
    shape_queries,
    source_queries,
    summary_queries,
)
from roadgrain.plans.registry import QUERIES

__all__ = ["QUERIES"]
