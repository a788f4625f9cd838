"""Catalogue: file sources and sinks.

Round-trip queries write into a fresh folder under the shared checkpoint
location, read the files back with the engine's readers and return what was
read; the oracle is the plain SELECT of what was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flightdeck.operators import gates as G
from flightdeck.operators import quality as Q
from flightdeck.operators.profile import schema_report, stratified_sample
from flightdeck.plans.pipeline import binding_fact, binding_staging, binding_warehouse
from flightdeck.plans.q_fact import _LOOKUP_SQL, airport_name_lookup, with_names
from flightdeck.plans.registry import query
from flightdeck.plans.sqltext import warehouse_ctes, with_staging
from flightdeck.schemas import STAGING_COLUMNS, STAGING_NAMES, staging_schema
from flightdeck.session import scratch_path
from flightdeck.sinks import files as SK
from flightdeck.sinks.tables import store, stored_path
from flightdeck.sources import files as SR
from flightdeck.sources.testdata import raw_flights

_WH = warehouse_ctes()
FIRST_YEAR, LAST_YEAR, REFRESH_YEAR = 1995, 2001, 1996
_EXPECTED_MONTHS = f"""(SELECT CAST(y.range AS INTEGER) AS file_year, CAST(m.range AS INTEGER) AS file_month
   FROM range({FIRST_YEAR}, {LAST_YEAR + 1}) y, range(1, 13) m)"""
_PRESENT_MONTHS = """(SELECT DISTINCT CAST(year(FL_DATE) AS INTEGER) AS file_year,
                           CAST(month(FL_DATE) AS INTEGER) AS file_month FROM stg)"""


#: The binding's rows are stored by month, so their scans deal no rows; the files that
#: queries write and read back are compressed.
FROM_MONTHS = {"clustered": True, "compression": "gzip"}
#: The raw files are read in several ways; the fast level takes a quarter less CPU to write.
RAW_FILES = {**FROM_MONTHS, "level": "BEST_SPEED"}


def _raw_monthly(spark, sf):
    """The binding's raw monthly files, written once per session; queries only read them."""
    return stored_path(spark, f"raw-monthly:{sf}", lambda path: SK.write_monthly_csv(
        raw_flights(spark, sf), path, **RAW_FILES), "raw-monthly")


@query("rt_raw_monthly_scan", with_staging("SELECT * FROM raw"))
def q_rt_raw_monthly_scan(spark, sf):
    return SR.read_raw(spark, _raw_monthly(spark, sf)).select(*STAGING_NAMES)


@query("file_manifest_diff", with_staging(f"""
SELECT e.file_year, e.file_month, CASE WHEN p.file_year IS NULL THEN 'missing' ELSE 'present' END AS status
FROM {_EXPECTED_MONTHS} e LEFT JOIN {_PRESENT_MONTHS} p
  ON p.file_year = e.file_year AND p.file_month = e.file_month"""))
def q_file_manifest_diff(spark, sf):
    return SR.file_manifest(spark, _raw_monthly(spark, sf), FIRST_YEAR, LAST_YEAR)


@query("header_diff", with_staging(f"""
SELECT file_year, file_month, CAST(0 AS INTEGER) AS missing_columns, CAST(0 AS INTEGER) AS extra_columns,
       TRUE AS same_order FROM {_PRESENT_MONTHS} p"""))
def q_header_diff(spark, sf):
    rep = SR.header_report(spark, _raw_monthly(spark, sf))
    return rep.groupBy("file_year", "file_month").agg(
        F.max("missing_columns").alias("missing_columns"),
        F.max("extra_columns").alias("extra_columns"),
        F.bool_and("same_order").alias("same_order"))


@query("check_union_complete", with_staging("""
SELECT 'union_rows' AS "check", CAST(NULL AS INTEGER) AS code, 'raw' AS subject,
       COUNT(*) AS observed, COUNT(*) AS expected, TRUE AS passed FROM raw
UNION ALL
SELECT 'header_matches', CAST(NULL AS INTEGER), 'raw', CAST(0 AS BIGINT), CAST(0 AS BIGINT), TRUE"""))
def q_check_union_complete(spark, sf):
    path = _raw_monthly(spark, sf)
    per_file = SR.read_raw(spark, path).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    source_rows = raw_flights(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    both = (per_file.select(F.lit("files").alias("_s"), "n")
            .unionByName(source_rows.select(F.lit("source").alias("_s"), "n"))
            .agg(F.sum(F.when(F.col("_s") == "files", F.col("n"))).alias("files"),
                 F.sum(F.when(F.col("_s") == "source", F.col("n"))).alias("source")))
    rows = Q.check_frame(both, "union_rows", None, F.lit("raw"), "files", "source")
    hdr = SR.header_report(spark, path).agg(
        F.count_if(~F.col("same_order") | (F.col("missing_columns") > 0)
                   | (F.col("extra_columns") > 0)).alias("bad"))
    return rows.unionByName(Q.check_frame(hdr, "header_matches", None, F.lit("raw"), "bad", 0))


def _processed_monthly(spark, sf):
    return stored_path(spark, f"processed-monthly:{sf}",
                       lambda path: SK.write_processed_monthly(binding_staging(spark, sf), path, **FROM_MONTHS),
                       "processed-monthly")


@query("rt_typed_scan", with_staging("SELECT * FROM stg"))
def q_rt_typed_scan(spark, sf):
    return SR.read_processed(spark, _processed_monthly(spark, sf))


def _text_sql():
    cols = []
    for c in STAGING_COLUMNS:
        if c.kind == "date":
            e = f"strftime({c.name}, '%Y-%m-%d')"
        elif c.sql_type == "BIT":
            e = f"CAST(CAST({c.name} AS INTEGER) AS VARCHAR)"
        else:
            e = f"CAST({c.name} AS VARCHAR)"
        cols.append(f"COALESCE({e}, '') AS {c.name}")
    return with_staging(f"SELECT {', '.join(cols)} FROM stg")


@query("rt_text_scan", _text_sql())
def q_rt_text_scan(spark, sf):
    return SR.read_text(spark, _processed_monthly(spark, sf))


@query("rt_monthly_export", with_staging("""
SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
       COUNT(*) AS row_count FROM stg GROUP BY 1, 2"""))
def q_rt_monthly_export(spark, sf):
    path = _processed_monthly(spark, sf)
    back = spark.read.options(**SK.CSV_OPTIONS).csv(path)
    return back.groupBy("file_year", "file_month").agg(F.count(F.lit(1)).alias("row_count"))


@query("rt_mapping_scan", with_staging(f"""
SELECT dap.AirportCode AS Airport_Code, COALESCE(m.Airport_Name, dap.AirportCode) AS Airport_Name
FROM dap LEFT JOIN ({_LOOKUP_SQL}) m ON m.Airport_Code = dap.AirportCode""", *warehouse_ctes()))
def q_rt_mapping_scan(spark, sf):
    """Mapping file for the airports the flights use, written the way the
    published mapping files are (UTF-8 BOM, CRLF line ends), then read back
    with the lookup reader."""
    wh = binding_warehouse(spark, sf)
    lookup = with_names(wh.airports, airport_name_lookup(spark, sf)).select(
        F.col("AirportCode").alias("Airport_Code"), F.col("AirportName").alias("Airport_Name"))
    header = spark.range(1).select(F.lit(0).alias("_o"),
                                   F.lit("\ufeffAirport_Code,Airport_Name").alias("value"))
    body = lookup.select(F.lit(1).alias("_o"),
                         F.concat_ws(",", "Airport_Code", "Airport_Name").alias("value"))
    path = scratch_path(spark, "mapping")
    # one row per airport code (a few hundred): a single ordered file
    (header.unionByName(body).coalesce(1).sortWithinPartitions("_o").select("value")
     .write.option("lineSep", "\r\n").text(path))
    return SR.read_mapping(spark, path)


@query("rt_yearly_snapshot", with_staging("SELECT * FROM raw"))
def q_rt_yearly_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    SK.write_snapshot(raw_flights(spark, sf), path)
    return spark.read.parquet(path)


SAMPLE_ROWS = 834


#: Columns that tell a flight.
SAMPLE_KEY = ["FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME"]


def rows_like(df, few, columns):
    """The rows of ``df`` whose hash over ``columns`` a row of ``few`` has too: every row
    that equals one of ``few``, as often as it occurs, and more.

    ``few`` (a bounded sample) is broadcast as its distinct hashes, so no row of ``df`` is
    dealt and none is copied.
    """
    digest = F.xxhash64(*[F.col(c) for c in columns])
    hashes = store(few.select(digest.alias("_hash")).distinct(), "sample-hashes")
    return df.join(F.broadcast(hashes), digest == F.col("_hash"), "left_semi")


@query("rt_sample_export", with_staging(f"""
SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
       CAST(LEAST(COUNT(*), {SAMPLE_ROWS}) AS BIGINT) AS sampled, CAST(0 AS BIGINT) AS not_in_staging
FROM stg GROUP BY 1, 2"""))
def q_rt_sample_export(spark, sf):
    """Per-month seeded sample with all 62 columns, written as one CSV (its size is
    bounded by 834 rows a month), read back and looked up in staging."""
    stg = binding_staging(spark, sf).select(*STAGING_NAMES)
    sample = stratified_sample(SK.with_file_partition(stg), list(SK.PARTITION_COLUMNS), SAMPLE_ROWS, 42, SAMPLE_KEY)
    path = scratch_path(spark, "sample")
    SK.write_small_csv(SK.processed_representation(sample.drop(*SK.PARTITION_COLUMNS)), path)
    back = SR.read_processed(spark, path)
    by_month = [F.year("FL_DATE").alias("file_year"), F.month("FL_DATE").alias("file_month")]
    counts = back.groupBy(*by_month).agg(F.count(F.lit(1)).alias("sampled"))
    # flights of the sample's keys, and of them the equal rows
    alike = rows_like(rows_like(stg, back, SAMPLE_KEY), back, STAGING_NAMES)
    strange = back.exceptAll(alike).groupBy(*by_month).agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(strange, ["file_year", "file_month"], "left").select(
        "file_year", "file_month", "sampled", F.coalesce("_n", F.lit(0)).alias("not_in_staging"))


@query("rt_partition_refresh", with_staging(f"""
SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
       CASE WHEN year(FL_DATE) = {REFRESH_YEAR} THEN 'v2' ELSE 'v1' END AS version, COUNT(*) AS row_count
FROM stg GROUP BY 1, 2, 3"""))
def q_rt_partition_refresh(spark, sf):
    """Load every month (v1), then re-deliver one year's months (v2): only
    those partitions are replaced."""
    stg = binding_staging(spark, sf).select(*STAGING_NAMES)
    path = scratch_path(spark, "refresh")
    SK.refresh_months(stg.withColumn("version", F.lit("v1")), path, clustered=True)
    again = stg.filter(F.year("FL_DATE") == REFRESH_YEAR).withColumn("version", F.lit("v2"))
    SK.refresh_months(again, path, clustered=True)
    back = spark.read.parquet(path)
    return back.groupBy("file_year", "file_month", "version").agg(F.count(F.lit(1)).alias("row_count"))


@query("empty_clone", with_staging("SELECT * FROM stg WHERE 1 = 0"))
def q_empty_clone(spark, sf):
    """An empty table with the staging structure (``WHERE 1 = 0`` clone)."""
    return binding_staging(spark, sf).select(*STAGING_NAMES).limit(0)


@query("rt_star_write", with_staging("""
SELECT 'dim_date' AS table_name, COUNT(*) AS row_count, 12 AS column_count FROM dd
UNION ALL SELECT 'dim_airline', COUNT(*), 4 FROM da
UNION ALL SELECT 'dim_airport', COUNT(*), 9 FROM dap
UNION ALL SELECT 'fact', COUNT(*), 42 FROM fb""", *_WH))
def q_rt_star_write(spark, sf):
    wh = binding_warehouse(spark, sf)
    root = scratch_path(spark, "star")
    tables = {"dim_date": wh.dates, "dim_airline": wh.airlines, "dim_airport": wh.airports,
              "fact": binding_fact(spark, sf)}
    out = None
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
        back = spark.read.parquet(f"{root}/{name}")
        one = back.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(len(back.columns)).alias("column_count"))
        out = one if out is None else out.unionByName(one)
    return out


@query("rt_publish", with_staging("""
SELECT COUNT(*) AS row_count, MIN(FlightKey) AS min_key, MAX(FlightKey) AS max_key FROM fact""", *_WH))
def q_rt_publish(spark, sf):
    """Write the fact as a new run, gate it (grain uniqueness), then point the
    manifest at it; readers go through the manifest."""
    root = scratch_path(spark, "published")
    fact = binding_fact(spark, sf)
    SK.publish(fact, root, uuid.uuid4().hex, gate=lambda df: Q.enforce(Q.grain_unique(df)))
    pub = SK.read_published(spark, root)
    return pub.agg(F.count(F.lit(1)).alias("row_count"), F.min("FlightKey").alias("min_key"),
                   F.max("FlightKey").alias("max_key"))


def _schema_report_sql() -> str:
    parts = [f"SELECT {i + 1} AS ordinal, '{f.name}' AS column_name, "
             f"'{f.dataType.simpleString()}' AS data_type, {str(c.nullable).upper()} AS nullable, "
             f"COUNT({f.name}) AS non_null_count, COUNT(*) AS row_count FROM stg"
             for i, (f, c) in enumerate(zip(staging_schema().fields, STAGING_COLUMNS))]
    return with_staging("\nUNION ALL ".join(parts))


@query("schema_report", _schema_report_sql())
def q_schema_report(spark, sf):
    """Column catalogue of the stored staging table (ordinal, name, type,
    declared nullability) with each column's non-NULL count and the row count."""
    stg = binding_staging(spark, sf).select(*STAGING_NAMES)
    return schema_report(stg, {c.name: c.nullable for c in STAGING_COLUMNS})


@query("rt_stream_month_load", with_staging("SELECT * FROM stg"))
def q_rt_stream_month_load(spark, sf):
    """Raw monthly files loaded by the incremental stream, read back as staging."""
    from flightdeck.streaming.monthly_files import load_new_months
    raw_dir = _raw_monthly(spark, sf)
    out = scratch_path(spark, "stream-staging")
    load_new_months(spark, raw_dir, out, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).select(*STAGING_NAMES)


@query("check_file_manifest", with_staging(f"""
SELECT "check", CAST(NULL AS INTEGER) AS code, 'manifest' AS subject, observed, expected,
       COALESCE(observed = expected, TRUE) AS passed FROM (
  SELECT 'monthly_files_missing' AS "check", COUNT(*) FILTER (WHERE p.file_year IS NULL) AS observed,
         CAST(0 AS BIGINT) AS expected FROM {_EXPECTED_MONTHS} e
         LEFT JOIN {_PRESENT_MONTHS} p ON p.file_year = e.file_year AND p.file_month = e.file_month
  UNION ALL
  SELECT 'monthly_files_present', COUNT(*) FILTER (WHERE p.file_year IS NOT NULL), COUNT(*)
  FROM {_EXPECTED_MONTHS} e
       LEFT JOIN {_PRESENT_MONTHS} p ON p.file_year = e.file_year AND p.file_month = e.file_month
  UNION ALL
  SELECT 'monthly_files_unrecognised', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT 'monthly_files_extra', CAST(0 AS BIGINT), CAST(NULL AS BIGINT)) c"""))
def q_check_file_manifest(spark, sf):
    return Q.manifest_checks(SR.file_manifest(spark, _raw_monthly(spark, sf), FIRST_YEAR, LAST_YEAR))


VANISHED = (2001, 11)


@query("rt_month_redelivery", with_staging(f"""
SELECT file_year, file_month, CAST(SUM(rows) AS BIGINT) AS row_count,
       CASE WHEN file_year = {REFRESH_YEAR} THEN 'load'
            WHEN file_year = {VANISHED[0]} AND file_month = {VANISHED[1]} THEN 'vanished' ELSE 'keep' END AS action
FROM (SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
             CASE WHEN year(FL_DATE) = {REFRESH_YEAR} AND OP_CARRIER_FL_NUM % 2 = 1 THEN 0
                  WHEN year(FL_DATE) = {VANISHED[0]} AND month(FL_DATE) = {VANISHED[1]} THEN 0 ELSE 1 END AS rows
      FROM stg) r
GROUP BY 1, 2"""))
def q_rt_month_redelivery(spark, sf):
    """All months are loaded by file state; one year is delivered again without its odd
    flight numbers and one month's files are withdrawn; the next refresh reloads the
    corrected months, drops the withdrawn one and leaves the others alone."""
    from flightdeck.sinks.tables import delete_folder
    from flightdeck.streaming.monthly_files import refresh_changed_months
    raw_dir, out, state = (scratch_path(spark, n) for n in ("redelivery-raw", "redelivery-staging", "redelivery-state"))
    raw = raw_flights(spark, sf)
    SK.write_monthly_csv(raw, raw_dir, **FROM_MONTHS)
    refresh_changed_months(spark, raw_dir, out, state)
    for month in range(1, 13):
        delete_folder(spark, f"{raw_dir}/file_year={REFRESH_YEAR}/file_month={month}")
    delete_folder(spark, f"{raw_dir}/file_year={VANISHED[0]}/file_month={VANISHED[1]}")
    corrected = raw.where((F.col("YEAR") == str(REFRESH_YEAR)) & (F.col("OP_CARRIER_FL_NUM").cast("long") % 2 == 0))
    SK.write_monthly_csv(corrected, raw_dir, mode="append", **FROM_MONTHS)
    months = refresh_changed_months(spark, raw_dir, out, state, drop_vanished=True)
    loaded = spark.read.parquet(out).groupBy(*SK.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
    return months.join(loaded, list(SK.PARTITION_COLUMNS), "left").select(
        *SK.PARTITION_COLUMNS, F.coalesce("row_count", F.lit(0)).alias("row_count"), "action")


@query("check_file_rows", with_staging("""
SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
       COUNT(*) AS file_rows, COUNT(*) AS parsed_rows, CAST(0 AS BIGINT) AS failed_checks FROM stg GROUP BY 1, 2"""))
def q_check_file_rows(spark, sf):
    """K7 file by file: lines of each raw file against its parsed rows, and its header,
    field counts and last line; summed up per month."""
    path = _raw_monthly(spark, sf)
    return _by_month(SR.file_report(spark, path), SR.parsed_rows(spark, path))


def _by_month(report, rows):
    report, rows = store(report, "file-report"), store(rows, "file-rows")
    checks = G.file_gates(report).unionByName(G.file_rows(report, rows)).where("NOT passed").groupBy(
        F.col("subject").alias("file_name")).agg(F.count(F.lit(1)).alias("_failed"))
    return (report.join(rows, "file_path", "left").join(checks, "file_name", "left").groupBy("file_year", "file_month")
            .agg(F.sum(F.greatest(F.col("lines") - 1, F.lit(0))).alias("file_rows"),
                 F.coalesce(F.sum("rows"), F.lit(0)).alias("parsed_rows"),
                 F.coalesce(F.sum("_failed"), F.lit(0)).alias("failed_checks")))


CUT_MONTH = (2000, 5)


@query("check_file_rows_defective", with_staging(f"""
SELECT CAST(year(FL_DATE) AS INTEGER) AS file_year, CAST(month(FL_DATE) AS INTEGER) AS file_month,
       COUNT(*) + CASE WHEN year(FL_DATE) = {CUT_MONTH[0]} AND month(FL_DATE) = {CUT_MONTH[1]} THEN 1 ELSE 0 END AS file_rows,
       COUNT(*) AS parsed_rows,
       CAST(CASE WHEN year(FL_DATE) = {CUT_MONTH[0]} AND month(FL_DATE) = {CUT_MONTH[1]} THEN 2 ELSE 0 END AS BIGINT) AS failed_checks
FROM stg GROUP BY 1, 2, year(FL_DATE), month(FL_DATE)"""))
def q_check_file_rows_defective(spark, sf):
    """K7 beside a file whose only line broke off: too few fields, and no row that parses."""
    path = scratch_path(spark, "raw-cut")
    SK.write_monthly_csv(raw_flights(spark, sf), path, **RAW_FILES)
    # one column whose name is the header line and whose value the broken one
    half = spark.range(1).select(F.lit(f"{CUT_MONTH[0]},2,{CUT_MONTH[1]},7").alias(",".join(STAGING_NAMES)))
    half.write.options(header="true", sep="\t").csv(f"{path}/file_year={CUT_MONTH[0]}/file_month={CUT_MONTH[1]}/cut")
    parsed = SR.parsed_rows(spark, path, mode="DROPMALFORMED", recursiveFileLookup="true", pathGlobFilter=SR.CSV_FILES)
    return _by_month(SR.file_report(spark, path), parsed)


LOAD_YEAR = 1996


@query("load_summary", with_staging(f"""
SELECT 'raw lines' AS stage, COUNT(*) AS rows, TRUE AS passed FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}
UNION ALL SELECT 'staging', COUNT(*), TRUE FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}
UNION ALL SELECT 'dim_date', CAST(366 AS BIGINT), TRUE
UNION ALL SELECT 'dim_airline', COUNT(DISTINCT OP_CARRIER_AIRLINE_ID), TRUE FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}
UNION ALL SELECT 'dim_airport', COUNT(DISTINCT id), TRUE FROM (
  SELECT ORIGIN_AIRPORT_ID AS id FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}
  UNION ALL SELECT DEST_AIRPORT_ID FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}) a
UNION ALL SELECT 'fact', COUNT(*), TRUE FROM stg WHERE year(FL_DATE) = {LOAD_YEAR}
UNION ALL SELECT 'gate ' || code, n, TRUE FROM (VALUES ('50002', 12), ('50003', 12), ('50004', 12), ('50005', 1), ('50020', 1),
  ('50021', 4), ('50022', 1), ('50030', 1), ('50031', 1), ('50032', 2), ('50033', 1), ('50034', 1), ('50035', 1),
  ('50036', 4), ('50037', 12), ('50038', 12), ('50039', 1)) g(code, n)"""))
def q_load_summary(spark, sf):
    """The whole load of one reporting year, files to published fact: rows after each
    stage, and for every numbered gate how many checks it made and whether all passed."""
    from flightdeck.plans.pipeline import LoadConfig, run_pipeline
    raw_dir, root = scratch_path(spark, "load-raw"), scratch_path(spark, "load-warehouse")
    SK.write_monthly_csv(raw_flights(spark, sf).where(F.col("YEAR") == str(LOAD_YEAR)), raw_dir, **FROM_MONTHS)
    load = run_pipeline(spark, LoadConfig(raw_dir, Q.Period(LOAD_YEAR, LOAD_YEAR), root, "first"))
    lines = SR.file_report(spark, raw_dir).agg(F.sum(F.col("lines") - 1).alias("rows")).select(
        F.lit("raw lines").alias("stage"), "rows")
    wh = load.warehouse
    for name, df in (("staging", wh.staging), ("dim_date", wh.dates), ("dim_airline", wh.airlines),
                     ("dim_airport", wh.airports), ("fact", load.fact)):
        lines = lines.unionByName(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows"))
    gates = load.checks.where("code IS NOT NULL").groupBy(F.concat(F.lit("gate "), F.col("code").cast("string")).alias("stage")).agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and("passed").alias("passed"))
    return lines.withColumn("passed", F.lit(True)).unionByName(gates)
