"""The operators as queries over the star-schema tables, each with its SQL twin."""

from sparkfeat.queries import boosted, builders, credit, encodings, features, learning, many, matrix, profiles, rollups  # noqa: F401
from sparkfeat.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
