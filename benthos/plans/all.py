"""All registered queries."""

from . import axes, choices, inputs, links, planes, streams, texts, tiles, timelines, trees  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
