"""Fresh folders for tables a query writes on its way.

The folder must be one every executor can reach. It is the one the cluster
names in ``spark.checkpoint.dir``. Where that is unset, a local temporary folder
is used in local mode, as in a test on one machine; on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


class NoSharedFolder(RuntimeError):
    """The cluster names no folder that all executors share."""


def shared_root(spark: SparkSession) -> str:
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise NoSharedFolder(f"spark.checkpoint.dir is not set, and executors of {master} share no local folder.")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path that no other call gets. Nothing is created."""
    path = f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return path


_open_scopes: list[list[str]] = []


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, at the end of the block, the folders that were asked for inside it.

    For a caller who is done with a result by then: frames built inside the block
    may read these folders and must not be used after it.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield made
    finally:
        _open_scopes.remove(made)
        hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
        for path in made:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(hadoop).delete(at, True)


def frozen(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and go on from the written table.

    Cuts the lineage: later steps see one fixed version of the rows, also when
    executors are lost and tasks run again.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
