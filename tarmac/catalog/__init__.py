"""Named queries over the test tables."""

from tarmac.catalog import exploration, flightlog, jobs, models, storage, streams  # noqa: F401
from tarmac.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
