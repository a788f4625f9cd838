"""Stored intermediate tables.

A table that several consumers read (staging rows, dimensions, the fact) is
written once as Parquet under the shared checkpoint folder and read back,
which cuts the lineage: consumers scan the stored columns they need (column
pruning, pushed filters) instead of recomputing the joins and conversions,
and a lost executor re-reads files instead of replaying the whole plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightdeck.session import scratch_path

#: (application, key) -> (path, schema as built)
_STORED: dict[tuple[str, str], tuple[str, T.StructType]] = {}
#: application -> scratch folders written by it, for :func:`forget`.
_WRITTEN: dict[str, list[str]] = {}


def sized_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``columns`` for a partitioned write, at file size.

    A rebalance: after the shuffle, AQE joins small partitions and splits large ones
    at the advisory size, so a tiny month is one file and a hot one gets as many tasks
    as it has bytes, instead of one file from every task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


#: Files a task of a clustered write keeps open; a task that meets more months sorts the rest.
OPEN_FILES = 16


@contextmanager
def open_files(spark: SparkSession, most: int):
    """A partitioned write inside keeps up to ``most`` files open instead of sorting rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write Parquet, laid out by ``partition_by`` in files of the advisory size."""
    if partition_by:
        sized_by(df, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("errorifexists").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table with the types and column order it was built with.

    Partition columns come last, and untyped, when files are read without a schema.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a fresh path in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    write_table(df, path, partition_by)
    return read_table(spark, path, df.schema)


def stored(spark: SparkSession, key: str, build: Callable[[], DataFrame],
           name: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Build-once table per application and ``key``; later calls read it."""
    app = spark.sparkContext.applicationId
    if (app, key) not in _STORED:
        df = build()
        path = scratch_path(spark, name or "table")
        _WRITTEN.setdefault(app, []).append(path)
        write_table(df, path, partition_by)
        _STORED[app, key] = (path, df.schema)
    return read_table(spark, *_STORED[app, key])


def stored_at(spark: SparkSession, key: str) -> str | None:
    """Path of the table that :func:`stored` keeps under ``key``, if it does."""
    return _STORED.get((spark.sparkContext.applicationId, key), (None,))[0]


def stored_path(spark: SparkSession, key: str, build: Callable[[str], None], name: str) -> str:
    """Build-once folder per application and ``key``: ``build`` writes it."""
    app = spark.sparkContext.applicationId
    if (app, key) not in _STORED:
        path = scratch_path(spark, name)
        _WRITTEN.setdefault(app, []).append(path)
        build(path)
        _STORED[app, key] = (path, T.StructType([]))
    return _STORED[app, key][0]


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` through Spark's file system; False where it is not there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forget(spark: SparkSession | None = None) -> None:
    """Drop the memo; next access rebuilds.  With a session, the folders that
    :func:`store` and :func:`stored` wrote for its application are deleted too, so
    frames read from them must not be used any more."""
    if spark is None:
        _STORED.clear()
        return
    app = spark.sparkContext.applicationId
    for k in [k for k in _STORED if k[0] == app]:
        del _STORED[k]
    for path in _WRITTEN.pop(app, []):
        delete_folder(spark, path)


# The warehouse namespaces.
NAMESPACES = ("staging", "dim", "fact", "analytics")


def namespaces(spark: SparkSession, root: str | None = None) -> dict[str, str]:
    """Path prefix per namespace under ``root`` (default: the shared folder).
    Idempotent: asking again returns the same prefixes; folders appear on the
    first write."""
    from flightdeck.session import checkpoint_root
    base = (root or f"{checkpoint_root(spark)}/flightdeck/warehouse").rstrip("/")
    return {n: f"{base}/{n}" for n in NAMESPACES}
