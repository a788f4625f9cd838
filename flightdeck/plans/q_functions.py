"""Catalogue: scalar functions (I1-I14), raw-token handling (A7) and the
conversion gates (K2-K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightdeck import functions as FN
from flightdeck.operators import clean as CL
from flightdeck.operators import report as R
from flightdeck.plans.registry import query, round6
from flightdeck.plans.sqltext import (
    MISSING_TOKENS_SQL, convert_sql, hhmm_sql, nullif_sql, parse_date_sql, strict_int_sql,
    with_flights, with_staging,
)
from flightdeck.schemas import STAGING_COLUMNS
from flightdeck.sources.testdata import airports, flights, raw_flights, table


def _lineitem(spark, sf):
    return table(spark, sf, "lineitem")


# --- I1 ----------------------------------------------------------------------
_RAW_HHMM_SQL = """CASE WHEN l_linenumber = 7 THEN NULL
     WHEN l_linenumber = 6 THEN CAST(-(l_orderkey % 100) AS VARCHAR)
     WHEN l_linenumber = 5 THEN CAST(l_orderkey % 2600 AS VARCHAR) || '.7'
     ELSE CAST(l_orderkey % 2600 AS VARCHAR) END"""


@query("hhmm_to_time", f"""
SELECT order_key, line_number, raw_hhmm, {hhmm_sql('raw_hhmm')} AS clock
FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_number, {_RAW_HHMM_SQL} AS raw_hhmm
      FROM lineitem) t""")
def q_hhmm_to_time(spark, sf):
    li = _lineitem(spark, sf)
    k = F.col("l_orderkey")
    raw = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
           .when(F.col("l_linenumber") == 6, (-(k % 100)).cast("string"))
           .when(F.col("l_linenumber") == 5, F.concat((k % 2600).cast("string"), F.lit(".7")))
           .otherwise((k % 2600).cast("string")))
    t = li.select(k.alias("order_key"), F.col("l_linenumber").alias("line_number"),
                  raw.alias("raw_hhmm"))
    return t.withColumn("clock", FN.hhmm_to_time("raw_hhmm"))


# --- I2 ----------------------------------------------------------------------
@query("parse_flight_date", f"""
SELECT event_id, raw_date, fl_date, raw_date IS NOT NULL AND fl_date IS NULL AS parse_failed
FROM (SELECT event_id, raw_date, {parse_date_sql('raw_date')} AS fl_date
      FROM (SELECT event_id,
                   CASE WHEN event_id % 97 = 0 THEN NULL
                        WHEN event_id % 89 = 0 THEN '13/' || strftime(ts, '%-d/%Y') || ' 12:00:00 AM'
                        ELSE strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p') END AS raw_date
            FROM events) e) p""")
def q_parse_flight_date(spark, sf):
    ev = table(spark, sf, "events")
    eid = F.col("event_id")
    raw = (F.when(eid % 97 == 0, F.lit(None).cast("string"))
           .when(eid % 89 == 0, F.concat(F.lit("13/"), F.date_format("ts", "d/yyyy"),
                                         F.lit(" 12:00:00 AM")))
           .otherwise(F.date_format("ts", "M/d/yyyy h:mm:ss a")))
    t = ev.select(eid, raw.alias("raw_date")).withColumn("fl_date", FN.parse_flight_date("raw_date"))
    return t.withColumn("parse_failed", F.col("raw_date").isNotNull() & F.col("fl_date").isNull())


# --- I3 ----------------------------------------------------------------------
@query("strict_integer", f"""
SELECT order_key, line_number, raw_value, {strict_int_sql('raw_value', 'INTEGER')} AS value,
       raw_value IS NOT NULL AND TRY_CAST(raw_value AS DOUBLE) IS NULL AS non_numeric,
       COALESCE(TRY_CAST(raw_value AS DOUBLE) <> FLOOR(TRY_CAST(raw_value AS DOUBLE)), FALSE) AS fractional
FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_number,
             CASE l_linenumber WHEN 1 THEN CAST(l_quantity AS VARCHAR)
                               WHEN 2 THEN CAST(l_quantity AS VARCHAR) || '5'
                               WHEN 3 THEN NULL
                               WHEN 4 THEN 'x' || CAST(l_partkey AS VARCHAR)
                               ELSE CAST(l_partkey AS VARCHAR) END AS raw_value
      FROM lineitem) t""")
def q_strict_integer(spark, sf):
    li = _lineitem(spark, sf)
    ln = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("string")
    raw = (F.when(ln == 1, qty).when(ln == 2, F.concat(qty, F.lit("5")))
           .when(ln == 3, F.lit(None).cast("string"))
           .when(ln == 4, F.concat(F.lit("x"), F.col("l_partkey").cast("string")))
           .otherwise(F.col("l_partkey").cast("string")))
    t = li.select(F.col("l_orderkey").alias("order_key"), ln.alias("line_number"),
                  raw.alias("raw_value"))
    return t.select("*", FN.strict_integer("raw_value", "int").alias("value"),
                    FN.is_non_numeric("raw_value").alias("non_numeric"),
                    FN.is_fractional("raw_value").alias("fractional"))


# --- calendar functions over the distinct ship dates -------------------------
_DATES_SQL = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS fl_date FROM lineitem) d"


def _dates(spark, sf):
    return _lineitem(spark, sf).select(F.to_date("l_shipdate").alias("fl_date")).distinct()


@query("date_key", f"""
SELECT fl_date, CAST(year(fl_date) * 10000 + month(fl_date) * 100 + day(fl_date) AS INTEGER) AS date_key
FROM {_DATES_SQL}""")
def q_date_key(spark, sf):
    return _dates(spark, sf).select("fl_date", FN.date_key("fl_date").alias("date_key"))


@query("date_parts", f"""
SELECT fl_date, CAST(year(fl_date) AS SMALLINT) AS year, CAST(quarter(fl_date) AS SMALLINT) AS quarter,
       CAST(month(fl_date) AS SMALLINT) AS month, CAST(day(fl_date) AS SMALLINT) AS day_of_month,
       CAST(year(fl_date) * 100 + month(fl_date) AS INTEGER) AS year_month
FROM {_DATES_SQL}""")
def q_date_parts(spark, sf):
    p = FN.date_parts("fl_date")
    return _dates(spark, sf).select(
        "fl_date", p["Year"].alias("year"), p["Quarter"].alias("quarter"),
        p["Month"].alias("month"), p["DayOfMonth"].alias("day_of_month"),
        FN.year_month_key("fl_date").alias("year_month"))


@query("date_names", f"""
SELECT fl_date, 'Q' || CAST(quarter(fl_date) AS VARCHAR) AS quarter_name,
       strftime(fl_date, '%B') AS month_name, strftime(fl_date, '%A') AS day_name
FROM {_DATES_SQL}""")
def q_date_names(spark, sf):
    n = FN.date_names("fl_date")
    return _dates(spark, sf).select("fl_date", n["QuarterName"].alias("quarter_name"),
                                    n["MonthName"].alias("month_name"),
                                    n["DayName"].alias("day_name"))


@query("iso_weekday", f"""
SELECT fl_date, CAST(isodow(fl_date) AS SMALLINT) AS iso_weekday, isodow(fl_date) IN (6, 7) AS is_weekend
FROM {_DATES_SQL}""")
def q_iso_weekday(spark, sf):
    return _dates(spark, sf).select("fl_date", FN.iso_weekday("fl_date").alias("iso_weekday"),
                                    FN.is_weekend("fl_date").alias("is_weekend"))


@query("zero_pad", f"""
SELECT fl_date, lpad(CAST(month(fl_date) AS VARCHAR), 2, '0') AS month_2d,
       lpad(CAST(day(fl_date) AS VARCHAR), 2, '0') AS day_2d
FROM {_DATES_SQL}""")
def q_zero_pad(spark, sf):
    return _dates(spark, sf).select("fl_date", FN.zero_pad(F.month("fl_date")).alias("month_2d"),
                                    FN.zero_pad(F.dayofmonth("fl_date")).alias("day_2d"))


@query("iso_date_text", f"""
SELECT fl_date, strftime(fl_date, '%Y-%m-%d') AS iso_text FROM {_DATES_SQL}""")
def q_iso_date_text(spark, sf):
    return _dates(spark, sf).select("fl_date", FN.iso_date_text("fl_date").alias("iso_text"))


# --- I9, I12, I14 ---------------------------------------------------------------
@query("bit_cast", """
SELECT order_key, line_number, raw_flag, CAST(raw_flag AS BOOLEAN) AS flag
FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_number,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber % 3 END AS raw_flag
      FROM lineitem) t""")
def q_bit_cast(spark, sf):
    li = _lineitem(spark, sf)
    ln = F.col("l_linenumber")
    t = li.select(F.col("l_orderkey").alias("order_key"), ln.alias("line_number"),
                  F.when(ln != 7, ln % 3).alias("raw_flag"))
    return t.withColumn("flag", FN.bit_cast("raw_flag"))


@query("safe_divide", with_flights("""
SELECT airline, cancelled_flights, diverted_flights,
       ROUND(CAST(cancelled_flights AS DOUBLE) / NULLIF(diverted_flights, 0), 6) AS cancelled_per_diverted
FROM (SELECT op_unique_carrier AS airline,
             COUNT(*) FILTER (WHERE COALESCE(is_cancelled, FALSE)) AS cancelled_flights,
             COUNT(*) FILTER (WHERE COALESCE(is_diverted, FALSE)) AS diverted_flights
      FROM fl GROUP BY 1) a"""))
def q_safe_divide(spark, sf):
    df = R.by_airline(flights(spark, sf), airports(spark, sf), R.NO_FILTER,
                      ["cancelled_flights", "diverted_flights"])
    return round6(df.withColumn("cancelled_per_diverted",
                                FN.safe_divide("cancelled_flights", "diverted_flights")))


@query("route_label", with_staging("""
SELECT DISTINCT ORIGIN AS origin_code, DEST AS dest_code, ORIGIN || ' → ' || DEST AS route FROM stg"""))
def q_route_label(spark, sf):
    stg = CL.clean(raw_flights(spark, sf))
    return (stg.select(F.col("ORIGIN").alias("origin_code"), F.col("DEST").alias("dest_code"))
            .distinct().withColumn("route", FN.route_label("origin_code", "dest_code")))


# --- A7: missing tokens ------------------------------------------------------------
def _token_sql():
    parts = []
    for c in STAGING_COLUMNS:
        parts.append(f"SELECT '{c.name}' AS column_name, COUNT(*) FILTER (WHERE {c.name} IS NULL) AS raw_nulls, "
                     f"COUNT(*) FILTER (WHERE {c.name} IN ({MISSING_TOKENS_SQL})) AS token_values, "
                     f"COUNT(*) FILTER (WHERE {c.name} IS NULL OR {c.name} IN ({MISSING_TOKENS_SQL})) AS nulls_after "
                     f"FROM raw")
    return with_staging("\nUNION ALL\n".join(parts))


@query("missing_tokens", _token_sql())
def q_missing_tokens(spark, sf):
    return CL.missing_token_profile(raw_flights(spark, sf))


# --- K2-K4: conversion gates --------------------------------------------------------
def _report_cte():
    parts = []
    for c in STAGING_COLUMNS:
        src = nullif_sql(c.name)
        conv = convert_sql(c, src)
        inv = f"COUNT(*) FILTER (WHERE {conv} = 'INVALID')" if c.kind == "clock" else "0"
        nonnum = (f"COUNT(*) FILTER (WHERE {src} IS NOT NULL AND TRY_CAST({src} AS DOUBLE) IS NULL)"
                  if c.kind == "int" else "0")
        frac = (f"COUNT(*) FILTER (WHERE TRY_CAST({src} AS DOUBLE) <> FLOOR(TRY_CAST({src} AS DOUBLE)))"
                if c.kind == "int" else "0")
        unparsed = (f"COUNT(*) FILTER (WHERE {src} IS NOT NULL AND {conv} IS NULL)"
                    if c.kind == "date" else "0")
        parts.append(f"SELECT '{c.name}' AS column_name, '{c.kind}' AS kind, "
                     f"COUNT(*) FILTER (WHERE {src} IS NULL) AS raw_nulls, "
                     f"COUNT(*) FILTER (WHERE {conv} IS NULL) AS converted_nulls, "
                     f"CAST({inv} AS BIGINT) AS invalid_clock, CAST({nonnum} AS BIGINT) AS non_numeric, "
                     f"CAST({frac} AS BIGINT) AS fractional, CAST({unparsed} AS BIGINT) AS unparsed_dates FROM raw")
    return "rep AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


_REPORT_CTE = _report_cte()


def _gate_sql(check, where, observed, expected):
    return with_staging(f"""
SELECT '{check}' AS "check", CAST(NULL AS INTEGER) AS code, column_name AS subject,
       CAST({observed} AS BIGINT) AS observed, CAST({expected} AS BIGINT) AS expected,
       COALESCE(CAST({observed} AS BIGINT) = CAST({expected} AS BIGINT), FALSE) AS passed
FROM rep WHERE {where}""", _REPORT_CTE)


def _report(spark, sf):
    """The conversion report of the binding, computed once per session (62
    rows) and read by every conversion gate."""
    from flightdeck.plans.pipeline import binding_staging
    from flightdeck.sinks.tables import stored
    return stored(spark, f"conversion_report:{sf}",
                  lambda: CL.conversion_report(raw_flights(spark, sf), binding_staging(spark, sf)),
                  "conversion_report")


@query("conversion_report", with_staging("SELECT * FROM rep", _REPORT_CTE))
def q_conversion_report(spark, sf):
    return _report(spark, sf)


def _gate_builder(check):
    def build(spark, sf):
        checks = CL.conversion_checks(_report(spark, sf))
        return checks.filter(F.col("check") == check)
    return build


query("check_clock_valid", _gate_sql("clock_valid", "kind = 'clock'", "invalid_clock", "0"))(
    _gate_builder("clock_valid"))
query("check_null_preserved", _gate_sql("null_preserved", "kind IN ('clock', 'date', 'int')",
                                        "converted_nulls", "raw_nulls"))(
    _gate_builder("null_preserved"))
query("check_conversion_failures", _gate_sql("conversion_failures", "kind IN ('date', 'int')",
                                             "non_numeric + fractional + unparsed_dates", "0"))(
    _gate_builder("conversion_failures"))
