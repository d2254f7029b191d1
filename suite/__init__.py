"""Queries over the driver's tables, each with its SQL twin where SQL can say it."""

from suite import ingest, models, stats, timeseries, warehouse
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "ingest", "models", "stats", "timeseries", "warehouse"]
