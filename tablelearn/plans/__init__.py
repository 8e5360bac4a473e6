"""The registered queries, each next to the SQL that must give the same rows."""

from . import evaluation, layouts, learning, repair, tables, transforms  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
