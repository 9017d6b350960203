"""Queries over the driver tables, one module per operator family."""

from skein.plans import aggregates, folds, gates, grounding, matching, notes, pages, rules, streams, timeline
from skein.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "aggregates", "folds", "gates", "grounding", "matching", "notes", "pages", "rules", "streams", "timeline"]
