"""Connected components of a graph that is given as pairs, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import frozen


def components(pairs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label): the least node of the component of each node that occurs in a pair.

    ``pairs`` has columns ``a`` and ``b`` (no NULLs). ``labels`` may give an earlier
    result, in which case the pairs join its components and all its nodes are
    returned.

    Each round points every node to its least neighbour, moves pairs to what their
    ends point to and drops those that have become loops. Of any pair at least one
    end moves, and a component of any shape is done after few rounds (at most
    logarithmic in its size, as every node but a local minimum disappears). Rounds
    are written to the shared folder; the driver sees counts only.
    """
    if labels is None:
        nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        labels = nodes.select("node", F.col("node").alias("label"))
    else:
        pairs = _moved(pairs, labels.select(F.col("node").alias("from"), F.col("label").alias("to")))
    edges = frozen(_proper(pairs), "components-edges")
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("b"))
        points = frozen(points.select("from", F.least("from", "b").alias("to")), "components-points")
        renamed = labels.join(points, F.col("label") == F.col("from"), "left")
        labels = frozen(renamed.select("node", F.coalesce("to", "label").alias("label")), "components-labels")
        edges = frozen(_proper(_moved(edges, points)), "components-edges")
    return labels


def _moved(pairs: DataFrame, points: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        joined = pairs.join(points, pairs[end] == F.col("from"), "left")
        pairs = joined.select(*(F.coalesce("to", c).alias(c) if c == end else F.col(c) for c in ("a", "b")))
    return pairs


def _proper(pairs: DataFrame) -> DataFrame:
    """Without loops, the lesser end first, each pair once."""
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.filter(F.col("a") != F.col("b")).distinct()
