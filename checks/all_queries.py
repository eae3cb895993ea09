"""All registered queries."""

from . import (cell_queries, focal_queries, layout_queries, source_queries,  # noqa: F401
               zone_queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
