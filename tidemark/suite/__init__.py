"""All registered queries."""

from . import cdc, drift, events, lineage, quality, stream, tables, text  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
