"""The registered queries and, next to each, the SQL that checks it."""

from catalog.base import ORACLES, QUERIES
from catalog import classes, edges, exploration, imputation, plots, profiling, rows, runs, stages  # noqa: F401  (register on import)

__all__ = ["QUERIES", "ORACLES"]
