"""Named queries over the fixture tables, each with its SQL oracle when one exists."""

from salesmart.plans import analysis, cleansing, deliveries, io, marts, models, streams, timeseries  # noqa: F401  (registers queries)
from salesmart.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
