"""Catalogue: data-quality gates over the staging rows and the warehouse
(K5, K6, K8-K21, K23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightdeck.operators import fact as FT
from flightdeck.operators import gates as G
from flightdeck.operators import quality as Q
from flightdeck.plans.pipeline import binding_fact, binding_staging, binding_warehouse
from flightdeck.plans.q_fact import monthly_reconciliation
from flightdeck.plans.registry import query
from flightdeck.plans.sqltext import warehouse_ctes, with_staging
from flightdeck.schemas import (
    FACT_GRAIN, FACT_KEYS, FACT_REQUIRED, INTEGER_RANGES, STAGING_COLUMNS, varchar_length,
)

# Reporting period of the binding: the ship-date years of the test tables.
PERIOD = Q.Period(1995, 2001)
_WH = warehouse_ctes()


def chk(check, code, subject, observed, expected, passed=None, source=""):
    code_sql = "NULL" if code is None else str(code)
    ok = passed or f"CAST({observed} AS BIGINT) IS NOT DISTINCT FROM CAST({expected} AS BIGINT)"
    return (f"SELECT '{check}' AS \"check\", CAST({code_sql} AS INTEGER) AS code, "
            f"CAST({subject} AS VARCHAR) AS subject, CAST({observed} AS BIGINT) AS observed, "
            f"CAST({expected} AS BIGINT) AS expected, COALESCE({ok}, FALSE) AS passed {source}")


def union(*parts):
    return "\nUNION ALL\n".join(parts)


def _ym(y, m):
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({m} AS VARCHAR), 2, '0'))"


# --- K5 ------------------------------------------------------------------
_YEARS = ",".join(str(y) for y in PERIOD.years)
_K5 = """k5 AS (SELECT COUNT(*) FILTER (WHERE FL_DATE IS NULL) AS nulls,
  array_to_string(list_sort(list(DISTINCT year(FL_DATE)) FILTER (WHERE FL_DATE IS NOT NULL)), ',') AS yrs,
  len(list(DISTINCT year(FL_DATE)) FILTER (WHERE FL_DATE IS NOT NULL)) AS nyrs,
  array_to_string(list_sort(list(DISTINCT month(FL_DATE)) FILTER (WHERE FL_DATE IS NOT NULL)), ',') AS mns,
  len(list(DISTINCT month(FL_DATE)) FILTER (WHERE FL_DATE IS NOT NULL)) AS nmns FROM stg)"""


@query("check_year_month_coverage", with_staging(union(
    chk("date_not_null", None, "'FL_DATE'", "nulls", "0", source="FROM k5"),
    chk("expected_years", None, "yrs", "nyrs", str(len(PERIOD.years)), f"yrs = '{_YEARS}'", "FROM k5"),
    chk("expected_months", None, "mns", "nmns", "12", "mns = '1,2,3,4,5,6,7,8,9,10,11,12'", "FROM k5")),
    _K5))
def q_k5(spark, sf):
    return Q.year_month_coverage(binding_staging(spark, sf), PERIOD)


# --- K6 ------------------------------------------------------------------
_K6 = """pm AS (SELECT year(FL_DATE) AS y, month(FL_DATE) AS m, COUNT(*) AS n FROM stg GROUP BY 1, 2),
k6 AS (SELECT COUNT(*) FILTER (WHERE m BETWEEN 1 AND 12) AS months_present,
  12 * COUNT(DISTINCT y) FILTER (WHERE m BETWEEN 1 AND 12) AS months_expected,
  COALESCE(SUM(n) FILTER (WHERE NOT COALESCE(m BETWEEN 1 AND 12, FALSE)), 0) AS unassigned,
  COALESCE(SUM(n) FILTER (WHERE m BETWEEN 1 AND 12), 0) AS split_rows,
  COALESCE(SUM(n), 0) AS total_rows FROM pm)"""


@query("check_split_complete", with_staging(union(
    chk("months_present", None, "'split'", "months_present", "months_expected", source="FROM k6"),
    chk("unassigned_rows", None, "'split'", "unassigned", "0", source="FROM k6"),
    chk("split_total", None, "'split'", "split_rows", "total_rows", source="FROM k6")), _K6))
def q_k6(spark, sf):
    return Q.split_complete(binding_staging(spark, sf))


# --- K8-K10 ----------------------------------------------------------------
_K8 = f"""em AS (SELECT CAST(y.range AS INTEGER) AS Year, CAST(m.range AS INTEGER) AS Month
        FROM range({PERIOD.first_year}, {PERIOD.last_year + 1}) y, range(1, 13) m),
hm AS (SELECT CAST(YEAR AS INTEGER) AS Year, CAST(MONTH AS INTEGER) AS Month, COUNT(*) AS n
       FROM stg GROUP BY 1, 2),
k8 AS (SELECT em.Year, em.Month, COALESCE(hm.n, 0) AS n FROM em LEFT JOIN hm
       ON hm.Year = em.Year AND hm.Month = em.Month)"""


@query("check_month_nonempty", with_staging(
    chk("month_nonempty", 50002, _ym("Year", "Month"), "n", "1", "n > 0", "FROM k8"), _K8))
def q_k8(spark, sf):
    return Q.month_nonempty(binding_staging(spark, sf), PERIOD)


_K9 = """k9 AS (SELECT CAST(YEAR AS INTEGER) AS Year, CAST(MONTH AS INTEGER) AS Month,
  COUNT(DISTINCT year(FL_DATE)) AS years, MIN(year(FL_DATE)) AS ylo, MAX(year(FL_DATE)) AS yhi,
  COUNT(DISTINCT month(FL_DATE)) AS months, MIN(month(FL_DATE)) AS mlo, MAX(month(FL_DATE)) AS mhi
  FROM stg GROUP BY 1, 2)"""


@query("check_month_purity", with_staging(union(
    chk("month_year_purity", 50003, _ym("Year", "Month"), "years", "1",
        "years = 1 AND ylo = Year AND yhi = Year", "FROM k9"),
    chk("month_month_purity", 50004, _ym("Year", "Month"), "months", "1",
        "months = 1 AND mlo = Month AND mhi = Month", "FROM k9")), _K9))
def q_k9(spark, sf):
    return Q.month_purity(binding_staging(spark, sf))


_K10 = """k10 AS (SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT YEAR, MONTH FROM stg
                                   WHERE YEAR IS NOT NULL AND MONTH IS NOT NULL) x) AS n,
                COUNT(*) AS rows FROM stg)"""


@query("check_all_months", with_staging(union(
    chk("all_months", 50005, "'staging'", "n", str(12 * len(PERIOD.years)), source="FROM k10"),
    chk("staging_rows", None, "'staging'", "rows", "NULL", "rows > 0", source="FROM k10")), _K10))
def q_k10(spark, sf):
    return Q.all_months(binding_staging(spark, sf), PERIOD)


# --- K11/K12 ---------------------------------------------------------------
_MISSING = """ml AS (SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE dd.DateKey IS NULL) AS missing_date,
       COUNT(*) FILTER (WHERE da.AirlineKey IS NULL) AS missing_airline,
       COUNT(*) FILTER (WHERE o.AirportKey IS NULL) AS missing_origin,
       COUNT(*) FILTER (WHERE d.AirportKey IS NULL) AS missing_destination
FROM stg s LEFT JOIN dd ON dd.Date = s.FL_DATE
LEFT JOIN da ON da.DOTAirlineID = s.OP_CARRIER_AIRLINE_ID
LEFT JOIN dap o ON o.AirportID = s.ORIGIN_AIRPORT_ID
LEFT JOIN dap d ON d.AirportID = s.DEST_AIRPORT_ID)"""


@query("check_lookups", with_staging(union(
    chk("source_not_empty", 50020, "'staging'", "total_rows", "1", "total_rows > 0", "FROM ml"),
    *[chk("lookup_resolved", 50021, f"'{d}'", f"missing_{d}", "0", source="FROM ml")
      for d in ("date", "airline", "origin", "destination")]), *_WH, _MISSING))
def q_k12(spark, sf):
    wh = binding_warehouse(spark, sf)
    return Q.lookups(FT.missing_lookups(wh.staging, wh.dates, wh.airlines, wh.airports))


# --- K13 -------------------------------------------------------------------
@query("check_row_reconciliation", with_staging(union(*[chk(
    "row_reconciliation", code, "'fact'", "(SELECT COUNT(*) FROM fb)", "(SELECT COUNT(*) FROM stg)")
    for code in (50022, 50030)]), *_WH))
def q_k13(spark, sf):
    wh, fact = binding_warehouse(spark, sf), binding_fact(spark, sf)
    return Q.row_reconciliation(wh.staging, fact).unionByName(
        Q.row_reconciliation(wh.staging, fact, code=50030))


# --- K15 -------------------------------------------------------------------
def _key(d):
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"


@query("check_calendar", with_staging(union(
    chk("calendar_rows", 50031, "'dim_date'", "COUNT(*)", str(PERIOD.days), source="FROM dd"),
    chk("calendar_first_day", 50032, "'dim_date'", _key("MIN(Date)"),
        _key(f"DATE '{PERIOD.first_date}'"), source="FROM dd"),
    chk("calendar_last_day", 50032, "'dim_date'", _key("MAX(Date)"),
        _key(f"DATE '{PERIOD.last_date}'"), source="FROM dd")), *_WH))
def q_k15(spark, sf):
    return Q.calendar(binding_warehouse(spark, sf).dates, PERIOD)


# --- K16-K19 ---------------------------------------------------------------
def _dups(table, keys):
    k = ", ".join(keys)
    return f"(SELECT COUNT(*) FROM (SELECT {k} FROM {table} GROUP BY {k} HAVING COUNT(*) > 1) x)"


@query("check_dim_unique", with_staging(union(
    chk("dim_unique", 50033, "'dim_airline'", _dups("da", ["DOTAirlineID"]), "0"),
    chk("dim_unique", 50034, "'dim_airport'", _dups("dap", ["AirportID"]), "0")), *_WH))
def q_k16(spark, sf):
    wh = binding_warehouse(spark, sf)
    return Q.dim_unique(wh.airlines, wh.airports)


@query("check_grain_unique", with_staging(
    chk("grain_unique", 50035, "'fact'", _dups("fb", list(FACT_GRAIN)), "0"), *_WH))
def q_k17(spark, sf):
    return Q.grain_unique(binding_fact(spark, sf))


_REF = """rf AS (SELECT COUNT(*) FILTER (WHERE dd.DateKey IS NULL) AS DateKey,
  COUNT(*) FILTER (WHERE da.AirlineKey IS NULL) AS AirlineKey,
  COUNT(*) FILTER (WHERE o.AirportKey IS NULL) AS OriginAirportKey,
  COUNT(*) FILTER (WHERE d.AirportKey IS NULL) AS DestinationAirportKey
  FROM fb LEFT JOIN dd ON dd.DateKey = fb.DateKey LEFT JOIN da ON da.AirlineKey = fb.AirlineKey
  LEFT JOIN dap o ON o.AirportKey = fb.OriginAirportKey
  LEFT JOIN dap d ON d.AirportKey = fb.DestinationAirportKey)"""


@query("check_referential", with_staging(union(
    *[chk("referential", 50036, f"'{k}'", k, "0", source="FROM rf") for k in FACT_KEYS]),
    *_WH, _REF))
def q_k18(spark, sf):
    wh = binding_warehouse(spark, sf)
    return Q.referential(binding_fact(spark, sf), wh.dates, wh.airlines, wh.airports)


@query("check_required_nulls", with_staging(union(
    *[chk("required_not_null", 50037, f"'{c}'", f"COUNT(*) FILTER (WHERE {c} IS NULL)", "0",
          source="FROM fb") for c in FACT_REQUIRED]), *_WH))
def q_k19(spark, sf):
    return Q.required_nulls(binding_fact(spark, sf))


# --- K20, K21 --------------------------------------------------------------
_MONTHLY = """sm AS (SELECT CAST(year(FL_DATE) AS SMALLINT) AS Year, CAST(month(FL_DATE) AS SMALLINT) AS Month,
                    COUNT(*) AS staging_rows FROM stg GROUP BY 1, 2),
fm AS (SELECT dd.Year, dd.Month, COUNT(*) AS fact_rows FROM fb JOIN dd ON dd.DateKey = fb.DateKey
       GROUP BY 1, 2),
rc AS (SELECT sm.Year, sm.Month, sm.staging_rows, fm.fact_rows FROM sm LEFT JOIN fm
       ON fm.Year = sm.Year AND fm.Month = sm.Month)"""


@query("check_monthly_recon", with_staging(
    chk("monthly_reconciliation", 50038, _ym("Year", "Month"), "COALESCE(fact_rows, 0)",
        "staging_rows", source="FROM rc"), *_WH, _MONTHLY))
def q_k20(spark, sf):
    wh = binding_warehouse(spark, sf)
    return Q.monthly_recon(monthly_reconciliation(wh.staging, binding_fact(spark, sf), wh.dates))


@query("check_fact_date_range", with_staging(chk(
    "fact_date_range", 50039, "'fact'",
    f"(SELECT COUNT(*) FROM fb JOIN dd ON dd.DateKey = fb.DateKey "
    f"WHERE NOT (dd.Date BETWEEN DATE '{PERIOD.first_date}' AND DATE '{PERIOD.last_date}'))", "0"),
    *_WH))
def q_k21(spark, sf):
    return Q.fact_date_range(binding_fact(spark, sf), binding_warehouse(spark, sf).dates, PERIOD)


# --- K23 -------------------------------------------------------------------
def _k23_sql():
    parts = [
        chk("primary_key", None, "'dim_date.DateKey'", _dups("dd", ["DateKey"]), "0"),
        chk("unique_key", None, "'dim_date.Date'", _dups("dd", ["Date"]), "0"),
        chk("primary_key", None, "'dim_airline.AirlineKey'", _dups("da", ["AirlineKey"]), "0"),
        chk("primary_key", None, "'dim_airport.AirportKey'", _dups("dap", ["AirportKey"]), "0"),
        chk("primary_key", None, "'fact.FlightKey'", _dups("fact", ["FlightKey"]), "0"),
    ]
    aggs = []
    for i, c in enumerate(STAGING_COLUMNS):
        if not c.nullable:
            aggs.append(f"COUNT(*) FILTER (WHERE {c.name} IS NULL) AS nn{i}")
            parts.append(chk("not_null", None, f"'{c.name}'", f"nn{i}", "0", source="FROM k23"))
        n = varchar_length(c.sql_type)
        if n is not None:
            aggs.append(f"COUNT(*) FILTER (WHERE length({c.name}) > {n}) AS ln{i}")
            parts.append(chk("text_length", None, f"'{c.name}'", f"ln{i}", "0", source="FROM k23"))
        if c.sql_type in ("TINYINT", "SMALLINT"):
            lo, hi = INTEGER_RANGES[c.sql_type]
            aggs.append(f"COUNT(*) FILTER (WHERE NOT (CAST({c.name} AS INTEGER) BETWEEN {lo} AND {hi})) AS rg{i}")
            parts.append(chk("integer_range", None, f"'{c.name}'", f"rg{i}", "0", source="FROM k23"))
    k23 = "k23 AS MATERIALIZED (SELECT " + ", ".join(aggs) + " FROM stg)"
    return with_staging(union(*parts), *_WH, k23)


@query("check_declared_constraints", _k23_sql())
def q_k23(spark, sf):
    wh = binding_warehouse(spark, sf)
    return Q.declared_constraints(wh.staging, wh.dates, wh.airlines, wh.airports,
                                  binding_fact(spark, sf))


# --- the fused gates, on the binding and on a load with known defects ----------
@query("fused_staging_gates", with_staging(union(
    chk("date_not_null", None, "'FL_DATE'", "nulls", "0", source="FROM k5"),
    chk("expected_years", None, "yrs", "nyrs", str(len(PERIOD.years)), f"yrs = '{_YEARS}'", "FROM k5"),
    chk("expected_months", None, "mns", "nmns", "12", "mns = '1,2,3,4,5,6,7,8,9,10,11,12'", "FROM k5"),
    chk("months_present", None, "'split'", "months_present", "months_expected", source="FROM k6"),
    chk("unassigned_rows", None, "'split'", "unassigned", "0", source="FROM k6"),
    chk("split_total", None, "'split'", "split_rows", "total_rows", source="FROM k6"),
    chk("all_months", 50005, "'staging'", "n", str(12 * len(PERIOD.years)), source="FROM k10"),
    chk("staging_rows", None, "'staging'", "rows", "NULL", "rows > 0", source="FROM k10"),
    chk("month_nonempty", 50002, _ym("Year", "Month"), "n", "1", "n > 0", "FROM k8"),
    chk("month_year_purity", 50003, _ym("Year", "Month"), "years", "1",
        "years = 1 AND ylo = Year AND yhi = Year", "FROM k9"),
    chk("month_month_purity", 50004, _ym("Year", "Month"), "months", "1",
        "months = 1 AND mlo = Month AND mhi = Month", "FROM k9")), _K5, _K6, _K8, _K9, _K10))
def q_fused_staging_gates(spark, sf):
    """K5, K6 and K8-K10 from one aggregation over staging."""
    return G.staging_gates(binding_staging(spark, sf), PERIOD)[0]


# every thirteenth flight is lost, one airport in seven, distances are blanked and one
# year is outside the period
SHORT_PERIOD = Q.Period(PERIOD.first_year, PERIOD.last_year - 1)
_BAD_FACT = ("bf AS (SELECT DateKey, AirlineKey, OriginAirportKey, DestinationAirportKey, FlightNumber, ScheduledDepTime, "
             "ScheduledArrTime, ScheduledDepTimeBlock, ScheduledArrTimeBlock, IsCancelled, IsDiverted, "
             "CASE WHEN FlightKey % 11 <> 0 THEN DistanceMiles END AS DistanceMiles FROM fact WHERE FlightKey % 13 <> 0)")
_BAD_MONTHS = """bs AS (SELECT CAST(year(FL_DATE) AS INTEGER) AS Year, CAST(month(FL_DATE) AS INTEGER) AS Month, COUNT(*) AS n
        FROM stg GROUP BY 1, 2),
bm AS (SELECT DateKey // 10000 AS Year, (DateKey // 100) % 100 AS Month, COUNT(*) AS n FROM bf GROUP BY 1, 2)"""


@query("fused_fact_gates_defective", with_staging(union(
    chk("row_reconciliation", 50030, "'fact'", "(SELECT COUNT(*) FROM bf)", "(SELECT COUNT(*) FROM stg)"),
    *[chk("referential", 50036, f"'{k}'",
          f"(SELECT COUNT(*) FROM bf WHERE {k} % 7 = 0)" if "Airport" in k else "0", "0") for k in FACT_KEYS],
    *[chk("required_not_null", 50037, f"'{c}'", f"(SELECT COUNT(*) - COUNT({c}) FROM bf)", "0") for c in FACT_REQUIRED],
    chk("fact_date_range", 50039, "'fact'",
        f"(SELECT COUNT(*) FROM bf WHERE DateKey // 10000 > {SHORT_PERIOD.last_year})", "0"),
    chk("monthly_reconciliation", 50038, _ym("bs.Year", "bs.Month"), "COALESCE(bm.n, 0)", "bs.n",
        source="FROM bs LEFT JOIN bm ON bm.Year = bs.Year AND bm.Month = bs.Month")), *_WH, _BAD_FACT, _BAD_MONTHS))
def q_fused_fact_gates_defective(spark, sf):
    """K13 and K18-K21 from one read of a fact with known defects: each must fail."""
    wh = binding_warehouse(spark, sf)
    fact = binding_fact(spark, sf).where("FlightKey % 13 <> 0").withColumn(
        "DistanceMiles", F.when(F.col("FlightKey") % 11 != 0, F.col("DistanceMiles")))
    months = G.staging_gates(wh.staging, SHORT_PERIOD)[1]
    return G.fact_gates(fact, wh.dates, wh.airlines, wh.airports.where("AirportKey % 7 <> 0"), months, SHORT_PERIOD)


@query("check_grain_unique_defective", with_staging(
    chk("grain_unique", 50035, "'fact'",
        "(SELECT COUNT(*) FROM (SELECT 1 FROM fact GROUP BY DateKey, AirlineKey HAVING COUNT(*) > 1) x)", "0"), *_WH))
def q_check_grain_unique_defective(spark, sf):
    """K17 on a grain too coarse for the flights: it must find the repeated keys."""
    return Q.grain_unique(binding_fact(spark, sf), ("DateKey", "AirlineKey"))


@query("check_lookups_defective", with_staging(union(
    chk("source_not_empty", 50020, "'staging'", "COUNT(*)", "1", "COUNT(*) > 0", "FROM stg"),
    chk("lookup_resolved", 50021, "'date'", "(SELECT COUNT(*) FROM stg JOIN dd ON dd.Date = stg.FL_DATE WHERE dd.DateKey % 7 = 0)", "0"),
    chk("lookup_resolved", 50021, "'airline'", "0", "0"),
    *[chk("lookup_resolved", 50021, f"'{side}'",
          f"(SELECT COUNT(*) FROM stg JOIN dap ON dap.AirportID = stg.{col} WHERE dap.AirportKey % 7 = 0)", "0")
      for side, col in (("origin", "ORIGIN_AIRPORT_ID"), ("destination", "DEST_AIRPORT_ID"))]), *_WH))
def q_check_lookups_defective(spark, sf):
    """K12 with dates and airports missing: the load must stop before the inner join."""
    wh = binding_warehouse(spark, sf)
    return Q.lookups(FT.missing_lookups(wh.staging, wh.dates.where("DateKey % 7 <> 0"), wh.airlines,
                                        wh.airports.where("AirportKey % 7 <> 0")))


@query("unresolved_rows_defective", with_staging("""
SELECT 'date' AS lookup, EXISTS (SELECT 1 FROM stg JOIN dd ON dd.Date = stg.FL_DATE WHERE dd.DateKey % 7 = 0) AS unresolved_exists
UNION ALL SELECT 'airline', FALSE
UNION ALL SELECT 'origin_airport', EXISTS (SELECT 1 FROM stg JOIN dap ON dap.AirportID = stg.ORIGIN_AIRPORT_ID WHERE dap.AirportKey % 7 = 0)
UNION ALL SELECT 'destination_airport', EXISTS (SELECT 1 FROM stg JOIN dap ON dap.AirportID = stg.DEST_AIRPORT_ID WHERE dap.AirportKey % 7 = 0)""",
    *_WH))
def q_unresolved_rows_defective(spark, sf):
    """D4 with dates and airports missing."""
    wh = binding_warehouse(spark, sf)
    return FT.unresolved_exists(wh.staging, wh.dates.where("DateKey % 7 <> 0"), wh.airlines,
                                wh.airports.where("AirportKey % 7 <> 0"))
