"""All registered queries with their SQL."""

from . import columns, managed, pipelines, relations, tables_in_out
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "columns", "managed", "pipelines", "relations", "tables_in_out"]
