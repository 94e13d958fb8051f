"""Registered queries over the driver's tables, each with the SQL that must give the same rows."""

from shelfscout.queries import aggregates, cleaning, features, files, graph, models, ranking, recommend, runs, segments
from shelfscout.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
