"""Catalogue: predicates and previews (C4-C11), aggregates and profiles
(E1-E16), stratified sample (F7), ordering (G1, G2), set operations (H1, H3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from flightdeck import functions as FN
from flightdeck.operators import profile as P
from flightdeck.operators.clean import nullif_tokens
from flightdeck.plans.pipeline import binding_fact, binding_staging, binding_warehouse
from flightdeck.plans.q_functions import q_hhmm_to_time, _RAW_HHMM_SQL
from flightdeck.plans.registry import query
from flightdeck.sinks.tables import store
from flightdeck.plans.sqltext import (
    AIRPORT_UNION_SQL, hhmm_sql, nullif_sql, warehouse_ctes, with_staging,
)
from flightdeck.schemas import CLOCK_COLUMNS, FACT_REQUIRED, STAGING_GRAIN, STAGING_NAMES, TEXT_COLUMNS
from flightdeck.sources.testdata import raw_flights, table

_WH = warehouse_ctes()
ONE_YEAR = 1996
SLICE_MONTH = 7
SAMPLE_PER_MONTH = 834
SAMPLE_SEED = 42
_ROW_COLS = ["FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST",
             "CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY"]
_ROW_SQL = ", ".join(_ROW_COLS)


# --- C4, C5, C6, C8 ----------------------------------------------------------
@query("out_of_range_dates", with_staging(f"""
SELECT DateKey, Date FROM dd
WHERE Date < DATE '{ONE_YEAR}-01-01' OR Date > DATE '{ONE_YEAR}-12-31'""", *_WH))
def q_out_of_range_dates(spark, sf):
    d = binding_warehouse(spark, sf).dates
    lo, hi = F.to_date(F.lit(f"{ONE_YEAR}-01-01")), F.to_date(F.lit(f"{ONE_YEAR}-12-31"))
    return d.filter(~F.col("Date").between(lo, hi)).select("DateKey", "Date")


@query("month_slice", with_staging(f"""
SELECT {_ROW_SQL} FROM stg WHERE year(FL_DATE) = {ONE_YEAR} AND month(FL_DATE) = {SLICE_MONTH}"""))
def q_month_slice(spark, sf):
    s = binding_staging(spark, sf)
    # the layout columns pick the folder; a date range, unlike year() and month(),
    # reaches the scan
    s = s.filter((F.col("YEAR") == ONE_YEAR) & (F.col("MONTH") == SLICE_MONTH))
    first = F.to_date(F.lit(f"{ONE_YEAR}-{SLICE_MONTH:02d}-01"))
    return s.filter((F.col("FL_DATE") >= first) & (F.col("FL_DATE") <= F.last_day(first))).select(*_ROW_COLS)


@query("unassigned_rows", with_staging(f"""
SELECT {_ROW_SQL} FROM stg WHERE FL_DATE IS NULL OR NOT (month(FL_DATE) BETWEEN 1 AND 12)"""))
def q_unassigned_rows(spark, sf):
    s = binding_staging(spark, sf)
    return s.filter(F.col("FL_DATE").isNull() | ~F.month("FL_DATE").between(1, 12)).select(*_ROW_COLS)


@query("required_null_rows", with_staging(f"""
SELECT FlightKey, {', '.join(FACT_REQUIRED)} FROM fact
WHERE {' OR '.join(c + ' IS NULL' for c in FACT_REQUIRED)}""", *_WH))
def q_required_null_rows(spark, sf):
    f = binding_fact(spark, sf)
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in FACT_REQUIRED])
    return f.filter(cond).select("FlightKey", *FACT_REQUIRED)


# --- C10, C11 ----------------------------------------------------------------
_HT = ["FlightKey", "DateKey", "FlightNumber", "ScheduledDepTime"]


@query("head_tail", with_staging(f"""
SELECT 'head' AS position, {', '.join(_HT)} FROM (SELECT * FROM fact ORDER BY FlightKey LIMIT 5) h
UNION ALL
SELECT 'tail' AS position, {', '.join(_HT)} FROM (SELECT * FROM fact ORDER BY FlightKey DESC LIMIT 5) t""",
    *_WH))
def q_head_tail(spark, sf):
    # the numbered rows are stored narrow, so both ends read one numbering
    f = store(binding_fact(spark, sf).select(*_HT), "head-tail")
    head = f.orderBy("FlightKey").limit(5).select(F.lit("head").alias("position"), *_HT)
    tail = f.orderBy(F.desc("FlightKey")).limit(5).select(F.lit("tail").alias("position"), *_HT)
    return head.unionByName(tail)


@query("invalid_value_sample", f"""
SELECT order_key, line_number, raw_hhmm, clock FROM (
  SELECT order_key, line_number, raw_hhmm, {hhmm_sql('raw_hhmm')} AS clock
  FROM (SELECT l_orderkey AS order_key, l_linenumber AS line_number, {_RAW_HHMM_SQL} AS raw_hhmm
        FROM lineitem) t) c
WHERE raw_hhmm IS NOT NULL AND clock = 'INVALID'
ORDER BY order_key, line_number, raw_hhmm LIMIT 10""")
def q_invalid_value_sample(spark, sf):
    df = q_hhmm_to_time(spark, sf)
    bad = df.filter(F.col("raw_hhmm").isNotNull() & FN.is_invalid_clock("clock"))
    return bad.orderBy("order_key", "line_number", "raw_hhmm").limit(10)


# --- E1-E5 -------------------------------------------------------------------
@query("row_count", with_staging("SELECT COUNT(*) AS row_count FROM fact", *_WH))
def q_row_count(spark, sf):
    return binding_fact(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


@query("date_range_and_count", with_staging("""
SELECT MIN(FL_DATE) AS min_date, MAX(FL_DATE) AS max_date, COUNT(*) AS row_count FROM stg"""))
def q_date_range_and_count(spark, sf):
    return binding_staging(spark, sf).agg(F.min("FL_DATE").alias("min_date"),
                                          F.max("FL_DATE").alias("max_date"),
                                          F.count(F.lit(1)).alias("row_count"))


@query("status_summary", with_staging("""
SELECT COUNT(*) AS total_flights,
       COUNT(*) FILTER (WHERE IsCancelled) AS cancelled_flights,
       COUNT(*) FILTER (WHERE IsDiverted) AS diverted_flights,
       COUNT(*) FILTER (WHERE IsDepDelayed15) AS dep_delayed15_flights,
       COUNT(*) FILTER (WHERE IsArrDelayed15) AS arr_delayed15_flights FROM fact""", *_WH))
def q_status_summary(spark, sf):
    f = binding_fact(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("total_flights"),
                 F.count_if("IsCancelled").alias("cancelled_flights"),
                 F.count_if("IsDiverted").alias("diverted_flights"),
                 F.count_if("IsDepDelayed15").alias("dep_delayed15_flights"),
                 F.count_if("IsArrDelayed15").alias("arr_delayed15_flights"))


@query("min_max_dates", with_staging("""
SELECT YEAR, MIN(FL_DATE) AS min_date, MAX(FL_DATE) AS max_date FROM stg GROUP BY YEAR"""))
def q_min_max_dates(spark, sf):
    return binding_staging(spark, sf).groupBy("YEAR").agg(F.min("FL_DATE").alias("min_date"),
                                                           F.max("FL_DATE").alias("max_date"))


@query("distinct_month_year", with_staging("""
SELECT YEAR, COUNT(DISTINCT month(FL_DATE)) AS distinct_months,
       COUNT(DISTINCT year(FL_DATE)) AS distinct_years FROM stg GROUP BY YEAR"""))
def q_distinct_month_year(spark, sf):
    return binding_staging(spark, sf).groupBy("YEAR").agg(
        F.count_distinct(F.month("FL_DATE")).alias("distinct_months"),
        F.count_distinct(F.year("FL_DATE")).alias("distinct_years"))


# --- E6-E10 --------------------------------------------------------------------
_NUNIQUE = ["TAIL_NUM", "CANCELLATION_CODE", "DIV1_AIRPORT", "DEP_TIME"]


@query("nunique_variants", with_staging("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS nunique, "
    f"COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS nunique_with_null FROM stg"
    for c in _NUNIQUE)))
def q_nunique_variants(spark, sf):
    return P.nunique(binding_staging(spark, sf), _NUNIQUE)


_DISTINCT = ["CANCELLATION_CODE", "DEP_TIME_BLK", "ARR_TIME_BLK", "ORIGIN_STATE_NM", "DEST_STATE_NM"]


@query("distinct_values", with_staging("\nUNION\n".join(
    f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM stg WHERE {c} IS NOT NULL"
    for c in _DISTINCT)))
def q_distinct_values(spark, sf):
    return P.distinct_values(binding_staging(spark, sf), _DISTINCT)


@query("month_histogram", with_staging("""
SELECT em.Year, em.Month, COALESCE(h.n, 0) AS row_count
FROM (SELECT CAST(y.range AS INTEGER) AS Year, CAST(m.range AS INTEGER) AS Month
      FROM range(1995, 2002) y, range(1, 13) m) em
LEFT JOIN (SELECT CAST(year(FL_DATE) AS INTEGER) AS Year, CAST(month(FL_DATE) AS INTEGER) AS Month,
                  COUNT(*) AS n FROM stg GROUP BY 1, 2) h
  ON h.Year = em.Year AND h.Month = em.Month"""))
def q_month_histogram(spark, sf):
    return P.month_histogram(binding_staging(spark, sf), 1995, 2001)


@query("dim_key_duplicates", with_staging(f"""
SELECT AirportID, COUNT(*) AS duplicate_count
FROM (SELECT DISTINCT * FROM ({AIRPORT_UNION_SQL.format(where='')}) u) d
GROUP BY AirportID HAVING COUNT(*) > 1"""))
def q_dim_key_duplicates(spark, sf):
    from flightdeck.operators import dims as D
    from flightdeck.operators.quality import duplicate_keys
    rows = D.airport_union(binding_staging(spark, sf)).distinct()
    return duplicate_keys(rows, ["AirportID"])


@query("grain_duplicates", with_staging(f"""
SELECT {', '.join(STAGING_GRAIN)}, COUNT(*) AS duplicate_count FROM stg
GROUP BY {', '.join(STAGING_GRAIN)} HAVING COUNT(*) > 1"""))
def q_grain_duplicates(spark, sf):
    from flightdeck.operators.quality import duplicate_keys
    return duplicate_keys(binding_staging(spark, sf), list(STAGING_GRAIN)).orderBy(
        F.desc("duplicate_count"))


# --- E11-E16 ---------------------------------------------------------------------
@query("null_profile", with_staging(
    "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, v{i} AS non_null, n{i} AS nulls FROM np"
                         for i, c in enumerate(STAGING_NAMES)),
    "np AS MATERIALIZED (SELECT " + ", ".join(
        f"COUNT({c}) AS v{i}, COUNT(*) FILTER (WHERE {c} IS NULL) AS n{i}"
        for i, c in enumerate(STAGING_NAMES)) + " FROM stg)"))
def q_null_profile(spark, sf):
    return P.null_profile(binding_staging(spark, sf), list(STAGING_NAMES))


_DURATIONS = ["CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME", "AIR_TIME", "TAXI_OUT", "TAXI_IN"]


@query("duration_profile", with_staging("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, ROUND(AVG({c}), 2) AS mean, "
    f"CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median FROM stg" for c in _DURATIONS)))
def q_duration_profile(spark, sf):
    return P.duration_profile(binding_staging(spark, sf), _DURATIONS)


def _hhmm_v(c):
    return f"TRY_CAST(TRUNC(TRY_CAST({nullif_sql(c)} AS DOUBLE)) AS BIGINT)"


@query("hhmm_profile", with_staging("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, MIN({_hhmm_v(c)}) AS min_value, MAX({_hhmm_v(c)}) AS max_value, "
    f"COUNT(*) FILTER (WHERE {_hhmm_v(c)} = 2400) AS n_2400, "
    f"COUNT(*) FILTER (WHERE {_hhmm_v(c)} > 2400) AS n_over_2400, "
    f"COUNT(*) FILTER (WHERE {_hhmm_v(c)} < 0) AS n_negative, "
    f"COUNT(*) FILTER (WHERE (({_hhmm_v(c)} % 100) + 100) % 100 > 59) AS n_bad_minutes FROM raw"
    for c in CLOCK_COLUMNS)))
def q_hhmm_profile(spark, sf):
    raw = raw_flights(spark, sf)
    cleaned = raw.select(*[nullif_tokens(F.col(c)).alias(c) for c in CLOCK_COLUMNS])
    return P.hhmm_profile(cleaned, list(CLOCK_COLUMNS))


@query("ordered_listagg", with_staging("""
SELECT airline, string_agg(ORIGIN, ',' ORDER BY ORIGIN) AS value_list
FROM (SELECT DISTINCT OP_UNIQUE_CARRIER AS airline, ORIGIN FROM stg WHERE ORIGIN IS NOT NULL) t
GROUP BY airline"""))
def q_ordered_listagg(spark, sf):
    """Origin airports served by each airline, as one ordered list per airline."""
    stg = binding_staging(spark, sf).select(F.col("OP_UNIQUE_CARRIER").alias("airline"), "ORIGIN")
    return P.ordered_listagg(stg, ["airline"], "ORIGIN", "ORIGIN")


def _vs_sql():
    def melt(src, conv):
        return "\nUNION\n".join(
            f"SELECT DISTINCT '{c}' AS column_name, CAST({conv(c)} AS VARCHAR) AS value FROM {src} "
            f"WHERE {conv(c)} IS NOT NULL" for c in TEXT_COLUMNS)
    return with_staging("""
SELECT column_name, COUNT(*) FILTER (WHERE a.value IS NULL) AS only_before,
       COUNT(*) FILTER (WHERE b.value IS NULL) AS only_after,
       COUNT(*) FILTER (WHERE a.value IS NULL) = 0 AND COUNT(*) FILTER (WHERE b.value IS NULL) = 0 AS unchanged
FROM vb b FULL OUTER JOIN va a USING (column_name, value) GROUP BY column_name""",
                        f"vb AS ({melt('raw', nullif_sql)})", f"va AS ({melt('stg', lambda c: c)})")


@query("value_set_unchanged", _vs_sql())
def q_value_set_unchanged(spark, sf):
    raw = raw_flights(spark, sf)
    before = raw.select(*[nullif_tokens(F.col(c)).alias(c) for c in TEXT_COLUMNS])
    return P.value_set_diff(before, binding_staging(spark, sf), list(TEXT_COLUMNS))


# --- F7 ----------------------------------------------------------------------------
@query("stratified_sample", with_staging(f"""
SELECT dd.YearMonth AS year_month, LEAST({SAMPLE_PER_MONTH}, COUNT(*)) AS sampled_rows
FROM fact JOIN dd ON dd.DateKey = fact.DateKey GROUP BY 1""", *_WH))
def q_stratified_sample(spark, sf):
    wh = binding_warehouse(spark, sf)
    # counting, drawing and drawing again read one numbering
    f = store(binding_fact(spark, sf).select("FlightKey", "DateKey"), "sample-keys").join(
        F.broadcast(wh.dates.select("DateKey", F.col("YearMonth").alias("year_month"))), "DateKey")
    sample = P.stratified_sample(f, ["year_month"], SAMPLE_PER_MONTH, SAMPLE_SEED, ["FlightKey"])
    return sample.groupBy("year_month").agg(F.count(F.lit(1)).alias("sampled_rows"))


# --- G1, G2, H1, H3 ----------------------------------------------------------------
@query("ordered_months", with_staging("""
SELECT dd.Year, dd.Month, COUNT(*) AS flights FROM fact JOIN dd ON dd.DateKey = fact.DateKey
GROUP BY 1, 2 ORDER BY 1, 2""", *_WH))
def q_ordered_months(spark, sf):
    wh = binding_warehouse(spark, sf)
    per_key = binding_fact(spark, sf).groupBy("DateKey").agg(F.count(F.lit(1)).alias("_n"))
    j = per_key.join(F.broadcast(wh.dates.select("DateKey", "Year", "Month")), "DateKey")
    return j.groupBy("Year", "Month").agg(F.sum("_n").cast("bigint").alias("flights")).orderBy(
        "Year", "Month")


@query("month_name_sorted", with_staging(
    "SELECT DISTINCT Month, MonthName FROM dd ORDER BY Month", *_WH))
def q_month_name_sorted(spark, sf):
    return binding_warehouse(spark, sf).dates.select("Month", "MonthName").distinct().orderBy("Month")


_UNION_COLS = ["FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID",
               "DEST_AIRPORT_ID", "CRS_DEP_TIME"]


@query("union_months", with_staging("\nUNION ALL\n".join(
    f"SELECT {', '.join(_UNION_COLS)}, CAST({m} AS INTEGER) AS slice_month FROM stg WHERE month(FL_DATE) = {m}"
    for m in range(1, 13))))
def q_union_months(spark, sf):
    """The twelve monthly slices of all years, stacked: one scan that keeps the
    rows with a month and names each row's slice."""
    month = F.month("FL_DATE")
    return (binding_staging(spark, sf).filter(month.between(1, 12))
            .select(*_UNION_COLS, month.cast("int").alias("slice_month")))


@query("table_counts", with_staging("""
SELECT 'staging' AS table_name, COUNT(*) AS row_count FROM stg
UNION ALL SELECT 'dim_date', COUNT(*) FROM dd
UNION ALL SELECT 'dim_airline', COUNT(*) FROM da
UNION ALL SELECT 'dim_airport', COUNT(*) FROM dap
UNION ALL SELECT 'fact', COUNT(*) FROM fb""", *_WH))
def q_table_counts(spark, sf):
    wh = binding_warehouse(spark, sf)
    parts = [("staging", wh.staging), ("dim_date", wh.dates), ("dim_airline", wh.airlines),
             ("dim_airport", wh.airports), ("fact", binding_fact(spark, sf))]
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count") for n, df in parts]
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- the same predicates where they find rows (C6, C8, E10) -------------------
_REST = ", ".join(_ROW_COLS[1:])


@query("unassigned_rows_defective", with_staging(f"""
SELECT CAST(NULL AS DATE) AS FL_DATE, {_REST} FROM stg WHERE OP_CARRIER_FL_NUM % 97 = 0"""))
def q_unassigned_rows_defective(spark, sf):
    """C6 where every 97th flight number has lost its date."""
    s = binding_staging(spark, sf).select(*_ROW_COLS)
    s = s.withColumn("FL_DATE", F.when(F.col("OP_CARRIER_FL_NUM") % 97 != 0, F.col("FL_DATE")))
    return s.filter(F.col("FL_DATE").isNull() | ~F.month("FL_DATE").between(1, 12))


@query("required_null_rows_defective", with_staging(f"""
SELECT FlightKey, {', '.join(c for c in FACT_REQUIRED if c != 'DistanceMiles')},
       CASE WHEN FlightKey % 997 <> 0 THEN DistanceMiles END AS DistanceMiles
FROM fact WHERE FlightKey % 997 = 0""", *_WH))
def q_required_null_rows_defective(spark, sf):
    """C8 where every 997th flight has lost its distance."""
    f = binding_fact(spark, sf).withColumn("DistanceMiles", F.when(F.col("FlightKey") % 997 != 0, F.col("DistanceMiles")))
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in FACT_REQUIRED])
    return f.filter(cond).select("FlightKey", *FACT_REQUIRED)


@query("grain_duplicates_coarse", with_staging("""
SELECT FL_DATE, OP_CARRIER_AIRLINE_ID, COUNT(*) AS duplicate_count FROM stg GROUP BY 1, 2 HAVING COUNT(*) > 1"""))
def q_grain_duplicates_coarse(spark, sf):
    """E10 on a grain too coarse for the flights."""
    from flightdeck.operators import quality as Q
    return Q.duplicate_keys(binding_staging(spark, sf), ["FL_DATE", "OP_CARRIER_AIRLINE_ID"])
