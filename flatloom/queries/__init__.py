"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from flatloom.queries import checks, corrections, counts, dedup, delta_checks, incremental, nested, reconcile, reports  # noqa: F401
from flatloom.queries.registry import QUERIES

__all__ = ["QUERIES"]
