"""Near-duplicate documents: sketches, bands, exact checks, components.

Two documents are linked when the Jaccard similarity of their shingle sets is
0.75 or more. Texts with equal sets are one class; only classes go on. Each
class gets a fast similarity sketch (``shingles.py``) of 48 bands of 4
coordinates: a pair at 0.75 shares no band with probability 1.2e-8. Classes that
share a band are candidates, and a link counts only after the full sets were
compared.

A bucket of many classes is not turned into all its pairs. Shingles that only one
candidate has bound what it can share with any other: a class with too many of
them has no link and leaves, which ends the groups that only share a passage. Of
the others every class is compared with one centre of its candidate component
(the class with the least share of such shingles, as a text that was copied), then, for a few rounds, with a pivot of each bucket that still holds classes of
several components; pairs within a component need no check, since the component
is all that is asked for. What is left after these rounds (buckets with classes
of different components) is compared pair by pair, unless the numbers of shingles
that both share with others and with their centre rule a link out. All bounds are
exact, so no link between candidates is lost.

Results: a NULL or blank text has the empty set and is linked with nothing, not
even with another one. Repeated rows stay repeated and are in one component. A
component is named by its least non-NULL id, NULL if it has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm import shingles
from tidemark.llm.common import BLANK_WORD, text_key
from tidemark.llm.components import components
from tidemark.sources.scratch import frozen

PERCENT = 75
PIVOT_ROUNDS = 3
# Up to so many 16-byte keys go to every executor; beyond that both sides are shuffled.
BROADCAST_ROWS = 500_000

_SKETCHED = StructType(
    [StructField("n", LongType()), StructField("node", BinaryType()), StructField("bands", ArrayType(LongType()))]
)


@F.arrow_udf(_SKETCHED)
def sketched(texts: pa.Array) -> pa.Array:
    """Set size, set digest and band hashes of texts; no digest and bands for empty sets."""
    sizes, nodes, bands = [], [], []
    for t in texts:
        elements = shingles.shingle_set(t.as_py())
        sizes.append(len(elements))
        nodes.append(shingles.set_digest(elements) if len(elements) else None)
        bands.append(shingles.band_hashes(shingles.sketch(elements)).view(np.int64) if len(elements) else None)
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
        names=["n", "node", "bands"],
    )


@F.arrow_udf(ArrayType(LongType()))
def full_set(texts: pa.Array) -> pa.Array:
    return pa.array([shingles.shingle_set(t.as_py()).view(np.int64) for t in texts], pa.list_(pa.int64()))


def _each(lists: pa.Array) -> list[np.ndarray]:
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


@F.arrow_udf(LongType())
def in_common(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([shingles.common(a, b) for a, b in zip(_each(left), _each(right))], pa.int64())


def _shared_buckets(bands: DataFrame) -> DataFrame:
    """(bucket, node, centre) of the buckets with two classes or more; the centre is the least of them."""
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre"))
    return bands.join(shared.filter("size > 1").drop("size"), "bucket")


def _sets(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, node, shingles): the full set of each candidate class, from one of its texts; ``id`` is a short name."""
    wanted = frozen(candidates, "near-wanted")
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.select(text_key(F.col("text")).alias("text_key"), "text")
    found = texts.join(F.broadcast(wanted) if few else wanted, "text_key")
    # Copies of a text meet here; each task brings one row at most.
    once = found.groupBy("node").agg(F.first("text").alias("text"))
    return frozen(
        once.select(F.monotonically_increasing_id().alias("id"), "node", full_set(F.col("text")).alias("shingles")), "near-sets"
    )


def _with_bounds(sets: DataFrame) -> DataFrame:
    """(node, n, s): set size, and how many of its shingles other candidates have too."""
    each = sets.select("id", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).filter("c = 1")
    alone = alone.groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    n = F.size("shingles").cast("long")
    sizes = sets.select("id", "node", n.alias("n")).join(alone, "id", "left")
    return sizes.select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def _alone() -> Column:
    """The share of a set that no other candidate has: least for the text that others are copies of."""
    return (F.col("n") - F.col("s")) / F.col("n")


def _overlap_allows(n_x: Column, s_x: Column, n_y: Column, s_y: Column) -> Column:
    """Whether two sets can be linked if each shares at most ``s`` of its ``n`` shingles."""
    most = F.least(s_x, s_y)
    return 100 * most >= PERCENT * (n_x + n_y - most)


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, inter) of pairs (a, b): how many shingles both have."""
    size = F.size("shingles").cast("long")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"), size.alias("n_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"), size.alias("n_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", "n_a", "n_b", in_common(F.col("set_a"), F.col("set_b")).alias("inter"))


def _linked() -> Column:
    return 100 * F.col("inter") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("inter"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with labels, of the buckets that hold several components."""
    labelled = members.join(labels, "node")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return frozen(labelled.join(mixed.filter("low <> high").select("bucket"), "bucket"), "near-open")


def _may_link(x: str, y: str) -> Column:
    """Different components, and neither what they share with others nor with their centre rules a link out.

    What both share lies in the centre, where it is at most what either shares with
    the centre, or outside, where it is at most what either shares with any other
    candidate outside. Classes of a bucket have one centre.
    """

    def least(value: str) -> Column:
        return F.least(*(F.expr(value.replace("@", side)) for side in (x, y)))

    within = least("@.i") + least("greatest(@.s - @.i, 0)")
    most = F.least(least("@.s"), F.when(F.col(f"{x}.i").isNotNull() & F.col(f"{y}.i").isNotNull(), within))
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    return (F.col(f"{x}.label") != F.col(f"{y}.label")) & (100 * most >= PERCENT * (total - most))


def _ends(x: str, y: str) -> list[Column]:
    ends = F.col(f"{x}.node"), F.col(f"{y}.node")
    return [F.least(*ends).alias("a"), F.greatest(*ends).alias("b")]


def _pivot_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(a, b) of each open bucket's pivot and its other members, where a link is possible and news.

    The pivot is at first the most typical member, later another one by chance.
    """
    row = F.struct("node", "n", "s", "i", "label")
    by = _alone() if turn == 0 else F.xxhash64("node", F.lit(turn))
    order = F.struct(by.alias("order"), row.alias("row"))
    pivots = members.groupBy("bucket").agg(F.min(order).alias("least")).select("bucket", F.col("least.row").alias("x"))
    met = members.select("bucket", row.alias("y")).join(pivots, "bucket")
    return met.filter(_may_link("x", "y")).select(*_ends("x", "y")).distinct()


def _left_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of all pairs of open buckets where a link is possible and news, each from the least bucket of both."""
    row = F.struct("node", "n", "s", "i", "label", "bands")
    with_bands = members.join(classes.select("node", "bands"), "node")
    x, y = with_bands.select("bucket", row.alias("x")), with_bands.select("bucket", row.alias("y"))
    least = F.array_min(F.array_intersect("x.bands", "y.bands"))
    met = x.join(y, "bucket").filter(
        (F.col("x.node") < F.col("y.node")) & _may_link("x", "y") & (F.col("bucket") == least)
    )
    return met.select(*_ends("x", "y"))


def _class_labels(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, label) of the classes that share a band with another one; None if no class does."""
    bands = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = frozen(_shared_buckets(bands), "near-buckets")
    nodes = buckets.select("node").distinct().join(classes.select("node", "text_key"), "node")
    sets = _sets(docs, nodes)
    bounds = _with_bounds(sets).filter(100 * F.col("s") >= PERCENT * F.col("n"))
    buckets = frozen(_shared_buckets(buckets.select("bucket", "node").join(bounds, "node")), "near-linkable")
    if buckets.isEmpty():
        return None
    centres = components(buckets.select(F.col("centre").alias("a"), F.col("node").alias("b")).filter("a <> b"))
    known = centres.join(buckets.select("node", "n", "s").distinct(), "node")
    row = F.struct("node", "n", "s")
    middle = known.groupBy("label").agg(F.min_by(row, F.struct(_alone(), "node")).alias("c"))
    nodes = frozen(known.join(middle, "label").select(row.alias("x"), "c"), "near-nodes")
    met = nodes.select("x", "c", *_ends("x", "c"))
    star = met.filter((F.col("a") != F.col("b")) & _overlap_allows(*map(F.col, ("x.n", "x.s", "c.n", "c.s"))))
    tested = frozen(_checked(star, sets), "near-tested")
    itself, centre = F.col("x.node") == F.col("c.node"), F.col("c.node")
    first = met.join(tested, ["a", "b"], "left").select(
        F.col("x.node").alias("node"),
        F.when(itself, F.col("x.n")).otherwise(F.col("inter")).alias("i"),
        F.when(itself | _linked(), centre).otherwise(F.col("x.node")).alias("label"),
    )
    first = frozen(first, "near-first")
    members = buckets.select("bucket", "node", "n", "s").join(first.select("node", "i"), "node")
    labels = first.select("node", "label")
    for turn in range(PIVOT_ROUNDS + 1):
        rest = _open(members, labels)
        if rest.isEmpty():
            break
        pairs = _pivot_pairs(rest, turn) if turn < PIVOT_ROUNDS else _left_pairs(rest, classes)
        news = frozen(_checked(pairs.join(tested, ["a", "b"], "left_anti"), sets), "near-tested")
        labels = components(news.filter(_linked()).select("a", "b"), labels)
        tested = tested.unionByName(news)
    return labels


def _grouped(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, text_key, n, node) and the component of each class: (node, group)."""
    texts = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"))
    found = texts.select("id", text_key(F.col("text")).alias("text_key"), sketched(F.col("text")).alias("s"))
    found = frozen(found.select("id", "text_key", "s.*"), "near-sketches")
    classes = found.filter(F.col("node").isNotNull()).groupBy("node")
    classes = frozen(
        classes.agg(F.first("n").alias("n"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands")), "near-classes"
    )
    labels = _class_labels(texts, classes)
    nodes = classes.select("node")
    if labels is None:
        groups = nodes.select("node", F.col("node").alias("group"))
    else:
        groups = nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("group"))
    return found.drop("bands"), groups


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id`` (least key of its component) and ``kept``.

    ``kept`` is true for the documents whose key is that of their component.
    """
    rows, groups = _grouped(docs, key, text)
    least = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least"))
    least = least.join(groups, "node")
    names = least.groupBy("group").agg(F.min("least").alias("component"))
    named = least.join(names, "group").select("node", "component")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.join(named, "node", "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns, one of each component: the one of least key.

    NULL keys come last, and of equal keys the text of least digest stays. Blank
    documents are in no component and all stay.
    """
    rows, groups = _grouped(docs, key, text)
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_key")
    least = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(rank).alias("least"))
    stays = least.join(groups, "node").groupBy("group").agg(F.min("least").alias("least"))
    stays = stays.select(F.col("least.id").alias("stay_id"), F.col("least.text_key").alias("stay_key"))
    whole = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[key].alias("id"), text_key(docs[text]).alias("text_key")
    )
    worded = F.coalesce(F.col(f"row.`{text}`"), F.lit("")).rlike(BLANK_WORD)
    met = whole.filter(worded).join(stays, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("text_key") == F.col("stay_key")))
    once = met.dropDuplicates(["id", "text_key"]).select("row")
    return once.unionAll(whole.filter(~worded).select("row")).select("row.*")
