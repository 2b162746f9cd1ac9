"""The latest row of each key, kept up to date batch by batch.

Three kinds of folders make up the table: the *delta* of a single batch, a *run*
merged from the deltas of ``every`` batches, and the *base*, into which ``every``
runs are merged. A key's latest row is the one of the highest batch in any folder.
So a reader opens one base, fewer than ``every`` runs and at most ``every`` deltas
however many batches there were, and a row of the base is written again once in
``every * every`` batches.

Each batch is published in a manifest with its number, so a batch that a restarted
stream repeats changes nothing. Merging is published apart: a merge that dies
leaves the folders it was reading in place, and the next batch merges them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.sources.committed import CommittedTable, Manifest

BATCH = "_batch"
DELTA, RUN, BASE = "delta", "run", "base"
EVERY = 10


def latest(updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the highest version for each key."""
    rest = [c for c in updates.columns if c not in (*keys, version)]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest, version), version).alias("_last"))
    return last.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in (*rest, version)))


class LatestTable:
    """``schema`` is that of the updates; a key has at most one row in a batch."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: list[str], every: int = EVERY):
        if every < 2:
            raise ValueError("a merge needs two folders or more")
        self.table = CommittedTable(spark, folder)
        self.schema, self.keys, self.every = schema, keys, every
        self.stored = StructType([*schema.fields, StructField(BATCH, LongType())])

    def read(self) -> DataFrame:
        """The latest row of each key, as of the newest manifest."""
        return self._merged(list(self.table.current().folders)).select(*self.schema.names)

    def folders(self) -> dict[str, dict]:
        """What a reader opens now."""
        return self.table.current().folders

    def add(self, batch: DataFrame, number: int) -> None:
        """Publish the updates of one batch, then merge if there is enough to merge.

        A batch without updates, as a stream makes them to close its windows, is not published.
        """
        now = self.table.current()
        if number > now.facts.get("batch", -1):
            seen = Observation()
            rows = batch.select(*self.schema.names).withColumn(BATCH, F.lit(number).cast("long"))
            delta = self.table.write(rows.observe(seen, F.count(F.lit(1)).alias("n")), DELTA)
            if not seen.get["n"]:
                return
            now = self.table.publish(now, {**now.folders, delta: {"kind": DELTA}}, {"batch": number})
        self._compact(now)

    def _merged(self, folders: list[str]) -> DataFrame:
        return latest(self.table.read(folders, self.stored), self.keys, BATCH)

    def _compact(self, now: Manifest) -> None:
        kinds = {kind: [f for f, known in now.folders.items() if known["kind"] == kind] for kind in (DELTA, RUN, BASE)}
        if len(kinds[DELTA]) < self.every:
            return
        # The run about to be made counts: with it there may be enough for the base.
        whole = len(kinds[RUN]) + 1 >= self.every
        taken = list(now.folders) if whole else kinds[DELTA]
        kind = BASE if whole else RUN
        made = self.table.write(self._merged(taken), kind)
        rest = {f: known for f, known in now.folders.items() if f not in taken}
        self.table.publish(now, {**rest, made: {"kind": kind}}, now.facts)
