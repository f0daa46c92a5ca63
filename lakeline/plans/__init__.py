"""Named queries over the tables, each with its SQL twin where one exists."""

from lakeline.plans import (  # noqa: F401  (importing registers the queries)
    clusters,
    features,
    keyed,
    neighbors,
    selection,
    sources,
    streams,
    supervised,
    tables,
    udfs,
)
from lakeline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
