"""Which monthly files were loaded, and what has changed since.

A state table holds path, length and modification time of every file that the last
refresh saw.  A new listing compared with it tells new, changed, deleted and unchanged
files; a month is touched if any of its files is not unchanged.  The listing is taken
*before* the files are read, so a file replaced during the load differs from its state
row and is loaded again by the next refresh.

States are versions under one folder, never overwritten: the newest complete one
counts, and a refresh that dies before writing its own leaves the earlier one, so its
months are simply loaded again.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.sources.files import CSV_FILES, file_months

STATE = "file_path string, length bigint, modified timestamp, file_year int, file_month int"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Path, length, modification time and month of every CSV file under ``path``.

    File contents are not read.  A folder without files gives no rows.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", CSV_FILES).load(path))
    year, month = file_months(F.col("path"))
    return files.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("modified"), year, month)


def _versions(spark: SparkSession, state_dir: str) -> list[int]:
    """Numbers of the complete versions under ``state_dir``, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state_dir}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("v")) for n in done if n.startswith("v"))


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The newest complete state; empty before the first refresh."""
    versions = _versions(spark, state_dir)
    if not versions:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{state_dir}/v{versions[-1]}")


def write_state(files: DataFrame, state_dir: str) -> None:
    """Keep ``files`` as the newest state."""
    spark = files.sparkSession
    number = max([time.time_ns(), *(v + 1 for v in _versions(spark, state_dir)[-1:])])
    files.select("file_path", "length", "modified", "file_year", "file_month").write.mode("errorifexists").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{state_dir}/v{number}")


def compare(found: DataFrame, state: DataFrame) -> DataFrame:
    """A row for each file of either side with its ``status``.

    ``new`` (no state), ``changed`` (other length or modification time), ``deleted``
    (state, but no file), ``unchanged``.  Length and time are those found now, or of
    the state for a deleted file.
    """
    f, s = found.alias("f"), state.alias("s")
    j = f.join(s, F.col("f.file_path") == F.col("s.file_path"), "full_outer")
    same = (F.col("f.length") == F.col("s.length")) & (F.col("f.modified") == F.col("s.modified"))
    status = (F.when(F.col("s.file_path").isNull(), "new").when(F.col("f.file_path").isNull(), "deleted")
              .when(same, "unchanged").otherwise("changed"))
    columns = ("file_path", "length", "modified", "file_year", "file_month")
    return j.select(*[F.coalesce(F.col(f"f.{c}"), F.col(f"s.{c}")).alias(c) for c in columns], status.alias("status"))


def month_status(files: DataFrame) -> DataFrame:
    """A row for each month: counts per file status, and what a refresh does with it.

    ``load`` (a file is new, changed or deleted and others remain), ``vanished`` (every
    file is gone), ``keep``.
    """
    def n(status: str):
        return F.count_if(F.col("status") == status)
    per = files.groupBy("file_year", "file_month").agg(
        n("new").alias("new_files"), n("changed").alias("changed_files"), n("deleted").alias("deleted_files"),
        n("unchanged").alias("unchanged_files"))
    left = F.col("new_files") + F.col("changed_files") + F.col("unchanged_files")
    touched = F.col("new_files") + F.col("changed_files") + F.col("deleted_files")
    return per.withColumn("action", F.when(left == 0, "vanished").when(touched > 0, "load").otherwise("keep"))
