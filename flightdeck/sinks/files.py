"""File sinks: monthly CSV export, snapshots, partition refresh, publish.

All writers are single distributed write actions.  Month partitioning uses
``partitionBy`` on copies of the calendar columns (``file_year``,
``file_month``) so the files keep the full column layout; Spark's writer
sorts each task's rows by the partition columns, so a task keeps one open
file at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightdeck.sinks.tables import OPEN_FILES, open_files, sized_by

# CSV dialect of the processed monthly files.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "nullValue": "",
               "dateFormat": "yyyy-MM-dd", "lineSep": "\n", "encoding": "UTF-8"}
PARTITION_COLUMNS = ("file_year", "file_month")


def with_file_partition(df: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    """Add the (year, month) a row belongs to as partition columns."""
    if isinstance(df.schema[date_col].dataType, T.DateType):
        d = F.col(date_col)
    else:
        from flightdeck.functions import parse_flight_date
        d = parse_flight_date(date_col)
    return df.withColumn("file_year", F.year(d)).withColumn("file_month", F.month(d))


def processed_representation(staging: DataFrame) -> DataFrame:
    """Flags as 0/1 integers (the processed files' representation)."""
    cols = []
    for f in staging.schema.fields:
        c = F.col(f.name)
        cols.append(c.cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else c)
    return staging.select(*cols)


def _write_by_month(df: DataFrame, date_col: str, clustered: bool, write: Callable[[DataFrameWriter], None],
                    mode: str) -> None:
    """One directory per (year, month), all months in one pass over the data.

    Rows are dealt by month at the advisory file size, unless they come ``clustered``
    (a task holds few months, as in a scan of files laid out by month): then wide rows
    are neither shuffled nor sorted, and each task keeps its months' files open.
    """
    rows = with_file_partition(df, date_col)
    if not clustered:
        rows = sized_by(rows, PARTITION_COLUMNS)
    with open_files(df.sparkSession, OPEN_FILES) if clustered else nullcontext():
        write(rows.write.mode(mode).partitionBy(*PARTITION_COLUMNS))


def write_monthly_csv(df: DataFrame, path: str, date_col: str = "FL_DATE", mode: str = "errorifexists",
                      clustered: bool = False, compression: str = "none", level: str | None = None) -> None:
    """Monthly CSV files; ``compression`` is a codec of Spark's text writers (``gzip``),
    ``level`` Hadoop's name of a zlib level (``BEST_SPEED``; its default where None)."""
    options = dict(CSV_OPTIONS, compression=compression)
    if level is not None:
        options["zlib.compress.level"] = level
    _write_by_month(df, date_col, clustered, lambda w: w.options(**options).csv(path), mode)


def write_processed_monthly(staging: DataFrame, path: str, clustered: bool = False, compression: str = "none") -> None:
    write_monthly_csv(processed_representation(staging), path, clustered=clustered, compression=compression)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Combined snapshot, unmodified (Parquet)."""
    df.write.mode("errorifexists").parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file for a result whose size is bounded by construction
    (a fixed-size sample, a lookup list).  ``repartition``, not ``coalesce``:
    only the finished rows meet in one task, not the work that makes them."""
    df.repartition(1).write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)


def refresh_months(df: DataFrame, path: str, date_col: str = "FL_DATE", clustered: bool = False) -> None:
    """Replace only the (year, month) partitions present in ``df``; every
    other month already under ``path`` stays (dynamic partition overwrite)."""
    _write_by_month(df, date_col, clustered,
                    lambda w: w.option("partitionOverwriteMode", "dynamic").parquet(path), "overwrite")


def publish(df: DataFrame, root: str, run_id: str,
            gate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All-or-nothing publish on plain files.

    1. write the new version to ``root/runs/<run_id>`` (never over the live path);
    2. run ``gate`` on the written copy (raises on failure -> nothing published);
    3. write a one-row manifest ``root/current/<run_id>`` naming the run.
    Readers resolve the newest manifest entry (:func:`read_published`), so they
    see either the previous version or the new one, never a partial write.
    """
    spark = df.sparkSession
    run_path = f"{root}/runs/{run_id}"
    df.write.mode("errorifexists").parquet(run_path)
    written = spark.read.parquet(run_path)
    if gate is not None:
        gate(written)
    manifest = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(run_path).alias("path"),
                                     F.current_timestamp().alias("published_at"),
                                     F.lit(time.time_ns()).alias("version"))
    manifest.write.mode("errorifexists").json(f"{root}/current/{run_id}")
    return written


def read_published(spark, root: str) -> DataFrame:
    """Read the version the newest manifest entry points to."""
    entries = spark.read.schema("run_id string, path string, published_at timestamp, version long").json(
        f"{root}/current/*")
    latest = entries.orderBy(F.desc("version"), F.desc("run_id")).limit(1).first()
    return spark.read.parquet(latest["path"])
