"""The named queries, one per operator, each with its SQL check where SQL can say it."""

from tidemark.queries import (  # noqa: F401  (importing registers the queries)
    aggregate,
    files,
    join,
    layered,
    mapreduce,
    production,
    relational,
    stream,
    window,
)
from tidemark.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
