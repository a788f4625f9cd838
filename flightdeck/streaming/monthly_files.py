"""Monthly raw files -> staging partitions, incrementally.

:func:`refresh_changed_months` is one refresh: the files under ``raw_dir`` are compared
with the file state of the last refresh (path, length, modification time), and every
month that has a new, changed or deleted file is read again in full, cleaned, and
replaces its partition.  A month may come in any number of files; a corrected file
under its old name is a changed one.  A month whose files are all gone is reported and,
unless asked to drop it, kept.

:func:`load_new_months` runs refreshes from a file stream (Structured Streaming): a
micro-batch means that files came, and when the stream has caught up one more refresh
looks for files that were replaced or deleted, which a file stream does not report.

* source: CSV files under ``raw_dir`` with the declared all-text schema (nothing is
  inferred, and a malformed row fails the load);
* staging is written before the state, so a refresh that fails is repeated; repeating
  one rewrites the same partitions (idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.operators.clean import clean
from flightdeck.schemas import raw_schema
from flightdeck.sinks.files import PARTITION_COLUMNS, refresh_months
from flightdeck.sinks.tables import delete_folder, store
from flightdeck.sources import file_state as FS
from flightdeck.sources.files import RAW_OPTIONS, file_months


def raw_file_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(raw_schema()).options(**RAW_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.option("recursiveFileLookup", "true").csv(raw_dir)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def _read_month(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Cleaned rows of files that all name one month; a row of another month raises."""
    raw = spark.read.schema(raw_schema()).options(**RAW_OPTIONS).csv(paths)
    year, month = file_months(F.col("_metadata.file_path"))
    staged = clean(raw.select("*", year.alias("_year"), month.alias("_month")))
    pure = (F.year("FL_DATE") == F.col("_year")) & (F.month("FL_DATE") == F.col("_month"))
    return staged.where(F.when(pure, F.lit(True)).otherwise(
        F.raise_error(F.lit("a raw file holds a row of another month than its name tells")).cast("boolean"))
    ).drop("_year", "_month")


def refresh_changed_months(spark: SparkSession, raw_dir: str, staging_dir: str, state_dir: str,
                           drop_vanished: bool = False) -> DataFrame:
    """Reload the months whose files changed; return what was found for each month.

    Rows: file_year, file_month, new_files, changed_files, deleted_files,
    unchanged_files, action (``load``, ``vanished``, ``keep``).  Months that are kept
    are neither read nor written.  A file whose path tells no month raises, for its
    rows would replace a month that is not reloaded.  A vanished month stays in staging
    and is reported again next time, until ``drop_vanished`` removes it.
    """
    files = store(FS.compare(FS.listing(spark, raw_dir), FS.read_state(spark, state_dir)), "file-status")
    months = store(FS.month_status(files), "month-status")
    unknown = months.where(F.col("file_year").isNull() | F.col("file_month").isNull())
    if not unknown.isEmpty():
        raise ValueError("a raw file's path tells no month")
    # a row a month, and the paths of the touched months only
    todo = files.where("status <> 'deleted'").join(
        months.where("action = 'load'").select(*PARTITION_COLUMNS), list(PARTITION_COLUMNS), "left_semi")
    paths = sorted(r["file_path"] for r in todo.select("file_path").collect())
    if paths:
        # a file holds one month, so the tasks of its scan hold few
        refresh_months(_read_month(spark, paths), staging_dir, clustered=True)
    gone = months.where("action = 'vanished'")
    if drop_vanished:
        for m in gone.select(*PARTITION_COLUMNS).collect():
            delete_folder(spark, f"{staging_dir}/file_year={m['file_year']}/file_month={m['file_month']}")
        seen = files.where("status <> 'deleted'")
    else:
        # their state stays, so that the next refresh finds them missing again
        seen = files.join(gone.select(*PARTITION_COLUMNS), list(PARTITION_COLUMNS), "left_semi").unionByName(
            files.where("status <> 'deleted'"))
    if not months.where("action <> 'keep'").isEmpty():
        FS.write_state(seen, state_dir)
    return months


def load_new_months(spark: SparkSession, raw_dir: str, staging_dir: str, checkpoint_dir: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Load every month with new, replaced or deleted files, then stop (``availableNow``).

    Returns the month report of the closing refresh.  The file state lives beside the
    stream's progress in ``checkpoint_dir``.
    """
    stream = raw_file_stream(spark, raw_dir, max_files_per_trigger)
    state_dir = f"{checkpoint_dir}/file-state"

    def write_batch(batch: DataFrame, _batch_id: int) -> None:
        refresh_changed_months(batch.sparkSession, raw_dir, staging_dir, state_dir)

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", f"{checkpoint_dir}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return refresh_changed_months(spark, raw_dir, staging_dir, state_dir)
