"""File sources: raw / processed / text CSV scans, lookups, manifests, headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.schemas import STAGING_NAMES, raw_schema, staging_read_schema, staging_schema, text_schema
from flightdeck.sinks.files import CSV_OPTIONS
from flightdeck.sinks.tables import store

RAW_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "enforceSchema": "false",
               "mode": "FAILFAST"}


#: Names of CSV files, plain or compressed by gzip.
CSV_FILES = "*.{csv,csv.gz}"


#: Option of the CSV reader: each line is split and checked whole, whatever columns are read.
WHOLE_LINES = {"columnPruning": "false"}


def read_raw(spark: SparkSession, path: str, lineage: bool = True) -> DataFrame:
    """All monthly raw files under ``path`` as text columns.

    The schema is declared (never inferred); ``enforceSchema=false`` makes
    Spark check each file's header against it and fail on a renamed or
    reordered header instead of silently mis-assigning columns.
    """
    df = spark.read.schema(raw_schema()).options(**RAW_OPTIONS).csv(path)
    if lineage:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def parsed_rows(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file_path, rows): rows of each raw file that the CSV reader parses, all fields of
    each line; ``options`` come on top of :data:`RAW_OPTIONS`.

    Without :data:`WHOLE_LINES` a count would take lines for rows.  No field is converted.
    """
    rows = spark.read.schema(raw_schema()).options(**{**RAW_OPTIONS, **WHOLE_LINES, **options}).csv(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of processed monthly CSV (flags arrive as 0/1)."""
    opts = dict(CSV_OPTIONS, enforceSchema="false", mode="FAILFAST")
    df = spark.read.schema(staging_read_schema()).options(**opts).csv(path)
    typed = staging_schema()
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed.fields])


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """All-text scan keeping blanks as empty strings (exact representation)."""
    opts = dict(CSV_OPTIONS, enforceSchema="false")
    df = spark.read.schema(text_schema()).options(**opts).csv(path)
    return df.select(*STAGING_NAMES).fillna("")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Code -> name lookup CSV (UTF-8 BOM and CRLF line ends are handled)."""
    return spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)


def file_months(path):
    """(file_year, file_month) named by a path: ``file_year=Y/file_month=M/`` folders
    or a ``Y_M.csv`` file; NULLs for any other name."""
    def named(folder: str, group: int):
        in_folder = F.regexp_extract(path, folder, 1)
        in_name = F.regexp_extract(path, r"(?:^|/)(\d{4})_(\d{2})\.csv(?:\.gz)?$", group)
        return F.when(in_folder != "", in_folder).otherwise(in_name).try_cast("int")
    return (named(r"file_year=(\d+)", 1).alias("file_year"), named(r"file_month=(\d+)", 2).alias("file_month"))


def monthly_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(file_year, file_month, file_path) of every data file under a monthly
    export; file contents are not read (binaryFile with the content pruned)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", CSV_FILES).load(path).select("path"))
    return files.select(*file_months(F.col("path")), F.col("path").alias("file_path"))


def file_manifest(spark: SparkSession, path: str, first_year: int, last_year: int) -> DataFrame:
    """Expected monthly partitions vs found, both directions.

    ``status`` is ``present``, ``missing`` (expected, no file), ``extra`` (file
    outside the expected months) or ``unrecognised`` (file whose name tells no
    month; its year and month are NULL).
    """
    found = monthly_partitions(spark, path).select("file_year", "file_month").distinct()
    expected = (spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("file_year"))
                .select("file_year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("file_month")))
    e = expected.withColumn("_e", F.lit(True))
    f = found.withColumn("_f", F.lit(True))
    j = e.join(f, ["file_year", "file_month"], "full_outer")
    return j.select("file_year", "file_month",
                    F.when(F.col("_e").isNotNull() & F.col("_f").isNotNull(), F.lit("present"))
                    .when(F.col("_e").isNotNull(), F.lit("missing"))
                    .when(F.col("file_year").isNull() | F.col("file_month").isNull(), F.lit("unrecognised"))
                    .otherwise(F.lit("extra"))
                    .alias("status"))


#: Most bytes that lines without an empty last field may have in a compressed file for
#: its bytes to be counted line by line; a piece of that count is never much longer.
MOST_BETWEEN = 64 << 20


def _unpacked_sizes(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """(file_path, _unpacked): the bytes inside each file compressed by gzip.

    Cut at ``cut`` instead of line ends, pieces and the cuts between them make up the
    file; behind the last piece there is a cut only if the file ends with one, and then
    the sum falls short of the file by its length.
    """
    pieces = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv.gz").option("lineSep", cut)
              .text(path).select("value", F.col("_metadata.file_path").alias("file_path")))
    return pieces.groupBy("file_path").agg((F.sum(F.octet_length("value") + len(cut)) - len(cut)).alias("_unpacked"))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_name, size) of every CSV file under ``path``, contents not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_FILES)
            .load(path).select(F.col("_metadata.file_path").alias("file_path"),
                               F.col("_metadata.file_name").alias("file_name"),
                               F.col("_metadata.file_size").alias("size")))


def _line_counts(spark: SparkSession, path: str, reference: tuple[str, ...]) -> DataFrame:
    """What one scan of the lines under ``path`` tells of each file that has a line.

    Every buffer is of fixed width, so lines are combined in a hash table and never
    sorted.  The header's names are compared inside ``min_by``, which looks at its value
    only where a line comes before all that were seen: at a file's first line.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_FILES).option("lineSep", "\n")
             .text(path).select("value", F.col("_metadata.file_path").alias("file_path"),
                                F.col("_metadata.file_block_start").alias("_start"))
             # a task reads a block's lines in order
             .withColumn("_order", F.monotonically_increasing_id()))
    header = F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), "\r$", "")
    hdr = F.split(F.regexp_replace(header, '"', ""), ",")
    ref = F.array(*[F.lit(c) for c in reference])
    place = F.when(F.col("_start") == 0, F.col("_order"))
    # commas between fields: those that no quotes enclose
    bare = F.regexp_replace("value", '"[^"]*"', "")
    fields = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    # a trim looks at every character: only a line that starts with a CR needs one
    filled = F.when(F.startswith("value", F.lit("\r")), F.trim("value", F.lit("\r")) != "").otherwise(F.col("value") != "")
    size = F.octet_length("value") + 1
    return lines.groupBy("file_path").agg(
        F.min_by(F.size(F.array_except(ref, hdr)), place).alias("missing_columns"),
        F.min_by(F.size(F.array_except(hdr, ref)), place).alias("extra_columns"),
        F.min_by(hdr == ref, place).alias("same_order"),
        F.count_if(filled).alias("lines"), F.count_if(filled & (fields != len(reference))).alias("odd_lines"),
        F.sum(size).alias("_bytes"), F.sum(F.when(~F.endswith("value", F.lit(",")), size)).alias("_between"))


def _header_columns(reference: tuple[str, ...]):
    """Header columns of :func:`_line_counts`, for a file without a line too: it has no column."""
    return (F.coalesce("missing_columns", F.lit(len(reference))).alias("missing_columns"),
            F.coalesce("extra_columns", F.lit(0)).alias("extra_columns"),
            F.coalesce("same_order", F.lit(False)).alias("same_order"))


def file_report(spark: SparkSession, path: str, reference: tuple[str, ...] = STAGING_NAMES) -> DataFrame:
    """A row for each CSV file under ``path``, from one scan of their lines.

    * file_path, file_name, file_year, file_month;
    * missing_columns, extra_columns, same_order: the header against ``reference``;
    * lines: lines that are not blank, header included;
    * odd_lines: such lines with another number of fields than ``reference``;
    * terminated: the file's bytes are those of its lines with an LF after each, so its
      last line is whole (a byte order mark aside).  A file compressed by gzip is of
      another size than its lines; there the bytes are counted in a second way.

    Spark's text source reads the files, so any file system and credentials that Spark
    knows will do, and a header may have any length.  The header is the first line of a
    file's first block (BOM and CR dropped).  Lines are combined per file before the
    shuffle; an empty file has no line and no column.  What the scan found is stored.

    Bytes of compressed files are counted in pieces cut behind an empty last field, about
    a line each, or at every comma if lines that end otherwise are too long in sum: a
    piece must fit in memory whatever a file holds.
    """
    seen = store(_line_counts(spark, path, reference), "file-lines")
    packed = F.col("file_name").endswith(".gz")
    between = seen.where(F.col("file_path").endswith(".gz")).agg(F.max("_between")).first()[0]
    cut = ",\n" if (between or 0) <= MOST_BETWEEN else ","
    unpacked, written = F.coalesce("_unpacked", F.lit(0)), F.coalesce("_bytes", F.lit(0))
    # a file that ends with the cut is short by its length, and whole if an LF is part of it
    short = [len(cut)] if cut.endswith("\n") else []
    whole = F.when(packed, (written - unpacked).isin(0, *short)).otherwise((F.col("size") - written).isin(0, 3))
    return _listed(spark, path).join(_unpacked_sizes(spark, path, cut), "file_path", "left").join(
        seen, "file_path", "left").select(
        "file_path", "file_name", *file_months(F.col("file_path")), *_header_columns(reference),
        F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("odd_lines", F.lit(0)).alias("odd_lines"),
        whole.alias("terminated"))


def header_report(spark: SparkSession, path: str, reference: tuple[str, ...] = STAGING_NAMES) -> DataFrame:
    """Per file: columns missing from / extra to the reference header, and
    whether the names are in the reference order."""
    return _listed(spark, path).join(_line_counts(spark, path, reference), "file_path", "left").select(
        *file_months(F.col("file_path")), *_header_columns(reference))
