"""Tables that grow by increments.

``IncrementalTable`` takes the rows after a high-water mark and publishes them and
the next mark in one step. ``VersionedTable`` keeps the type 2 history of a change
log up to date by merging increments of the log. Both are committed tables
(``sources.committed``): an increment that dies on the way has changed nothing, and
the next attempt starts from the same state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.operators.blocks import Limits, same_keys
from tidemark.operators.history import as_text, since, versions
from tidemark.plans.sizing import broadcast_if_small
from tidemark.sources.committed import CommittedTable, Manifest
from tidemark.sources.sinks import write_partitioned

EVERY = 10
BUCKETS = 64
_BUCKET = "_bucket"
_NEW = "_new"


class IncrementalTable:
    """Rows processed so far, in the order of a column that only grows.

    ``schema`` is that of the stored rows. ``every`` folders of one tier are merged
    into one of the next, so a table of n increments has at most ``every - 1``
    folders for each power of ``every`` in n, and a row is written again once a tier.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, column: str, every: int = EVERY):
        if every < 2:
            raise ValueError("a merge needs two folders or more")
        self.table = CommittedTable(spark, folder)
        self.schema, self.column, self.every = schema, column, every

    def mark(self) -> str | None:
        """The greatest value processed, as text that casts back to it; None before the first increment."""
        return self.table.current().facts.get("mark")

    def read(self) -> DataFrame:
        return self.table.read(list(self.table.current().folders), self.schema)

    def process(self, source: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> str | None:
        """Add what ``change`` makes of the source rows after the mark, and return the new mark.

        The mark is the greatest value among the rows that went in, whatever came out
        of them, and is observed while they are written. Without rows after the mark
        the table stays as it is. Rows without a value are never after a mark; the first
        increment takes them too.
        """
        now = self.table.current()
        seen = Observation()
        reached = as_text(F.max(self.column), source.schema[self.column].dataType)
        rows = since(source, self.column, now.facts.get("mark"))
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), reached.alias("mark"))
        made = self.table.write(change(rows).select(*self.schema.names), "rows")
        if not seen.get["n"]:
            return now.facts.get("mark")
        facts = {"mark": seen.get["mark"] or now.facts.get("mark")}
        self._compact(self.table.publish(now, {**now.folders, made: {"tier": 0}}, facts))
        return facts["mark"]

    def _compact(self, now: Manifest) -> None:
        """Merge tiers that are full, the lowest first, all in one new folder."""
        taken: list[str] = []
        tier = 0
        while True:
            same = [f for f, known in now.folders.items() if known["tier"] == tier]
            if len(same) + bool(taken) < self.every:
                break
            taken += same
            tier += 1
        if not taken:
            return
        made = self.table.write(self.table.read(taken, self.schema).hint("rebalance"), "merged")
        rest = {f: known for f, known in now.folders.items() if f not in taken}
        self.table.publish(now, {**rest, made: {"tier": tier}}, now.facts)


class VersionedTable:
    """Type 2 history of a change log, stored in buckets of keys.

    A change is known by its key, moment and tie; delivered again it replaces itself.
    Changes may come in any order: one that lies between stored changes gets its place
    and ends the version before it. After any sequence of merges the table is what
    ``history.versions`` makes of all changes at once.

    A merge reads and writes only the buckets of the keys it touches, and orders only
    the changes of these keys; a key with very many changes is cut into blocks as in
    ``versions``. The number of buckets is fixed when the table is first written.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        changes: StructType,
        key: str,
        moment: str,
        tie: str,
        attributes: list[str],
        buckets: int = BUCKETS,
    ):
        self.table = CommittedTable(spark, folder)
        self.buckets = self.table.current().facts.get("buckets", buckets)
        self.key, self.moment, self.tie, self.attributes = key, moment, tie, attributes
        of = {f.name: f.dataType for f in changes.fields}
        self.log = StructType([StructField(c, of[c]) for c in (key, moment, tie, *attributes)])
        self.schema = StructType(
            [
                *(StructField(c, of[c]) for c in (key, tie, *attributes)),
                StructField("valid_from", of[moment]),
                StructField("valid_to", of[moment]),
                StructField("is_current", BooleanType()),
            ]
        )

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _stored(self, now: Manifest, buckets: set[int] | None = None) -> DataFrame:
        """The stored versions, of some buckets or of all."""
        places = [
            f"{folder}/{_BUCKET}={b}"
            for folder, known in now.folders.items()
            for b in known["buckets"]
            if buckets is None or b in buckets
        ]
        return self.table.read(places, self.schema)

    def read(self) -> DataFrame:
        return self._stored(self.table.current())

    def merge(self, changes: DataFrame, limits: Limits = Limits()) -> int:
        """Bring changes into the history; how many buckets were written again.

        ``changes`` is read more than once and should be a stored table.
        """
        now = self.table.current()
        log = changes.select(*self.log.names)
        touched = {r[0] for r in log.select(self._bucket()).distinct().collect()}  # one row a bucket at most
        if not touched:
            return 0
        stored = self._stored(now, touched)
        keys = broadcast_if_small(log.select(self.key).distinct())
        same = same_keys(stored, keys, [self.key])
        known = stored.join(keys, same, "left_semi").withColumnRenamed("valid_from", self.moment)
        both = known.select(*self.log.names, F.lit(False).alias(_NEW)).unionByName(log.withColumn(_NEW, F.lit(True)))
        whole = F.max_by(F.struct(*self.attributes), _NEW).alias("_whole")
        once = both.groupBy(self.key, self.moment, self.tie).agg(whole)
        ordered = versions(
            once.select(self.key, self.moment, self.tie, "_whole.*"), self.key, self.moment, self.tie, self.attributes, limits
        )
        merged = stored.join(keys, same, "left_anti").unionByName(ordered.select(*self.schema.names))
        made = self.table.new_folder("versions")
        write_partitioned(merged.withColumn(_BUCKET, self._bucket()), self.table.location(made), [_BUCKET])
        folders = {}
        for folder, of in now.folders.items():
            left = [b for b in of["buckets"] if b not in touched]
            if left:
                folders[folder] = {"buckets": left}
        self.table.publish(now, {**folders, made: {"buckets": sorted(touched)}}, {"buckets": self.buckets})
        return len(touched)
