"""Registered queries: every operator on the whole driver tables, with SQL twins."""

from . import evaluation, feeds, memos, models, quality_loads, scans, universe
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "evaluation", "feeds", "memos", "models", "quality_loads", "scans", "universe"]
