"""Catalogue: fact build and its joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightdeck.operators import fact as FT
from flightdeck.plans.pipeline import binding_fact, binding_warehouse
from flightdeck.plans.registry import query
from flightdeck.plans.sqltext import _fact_body_select, warehouse_ctes, with_staging
from flightdeck.sources.testdata import table

_WH = warehouse_ctes()


@query("fact_projection", with_staging(f"SELECT {_fact_body_select()} FROM stg s"))
def q_fact_projection(spark, sf):
    wh = binding_warehouse(spark, sf)
    return wh.staging.select(*FT.project_fact_columns(wh.staging))


_GRAIN_SRC = ["FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID",
              "DEST_AIRPORT_ID", "CRS_DEP_TIME"]


@query("fact_key_resolution", with_staging(f"""
SELECT {', '.join('s.' + c for c in _GRAIN_SRC)}, dd.DateKey, da.AirlineKey,
       o.AirportKey AS OriginAirportKey, d.AirportKey AS DestinationAirportKey
FROM stg s JOIN dd ON dd.Date = s.FL_DATE JOIN da ON da.DOTAirlineID = s.OP_CARRIER_AIRLINE_ID
JOIN dap o ON o.AirportID = s.ORIGIN_AIRPORT_ID JOIN dap d ON d.AirportID = s.DEST_AIRPORT_ID""", *_WH))
def q_fact_key_resolution(spark, sf):
    wh = binding_warehouse(spark, sf)
    r = FT.resolve_keys(wh.staging.select(*_GRAIN_SRC), wh.dates, wh.airlines, wh.airports)
    return r.select(*_GRAIN_SRC, "DateKey", "AirlineKey", "OriginAirportKey", "DestinationAirportKey")


@query("role_playing_airports", with_staging("""
SELECT f.OriginAirportKey, o.AirportCode AS OriginAirportCode, o.StateName AS OriginStateName,
       f.DestinationAirportKey, d.AirportCode AS DestinationAirportCode,
       d.StateName AS DestinationStateName, COUNT(*) AS flights
FROM fb f JOIN dap o ON o.AirportKey = f.OriginAirportKey
          JOIN dap d ON d.AirportKey = f.DestinationAirportKey
GROUP BY 1, 2, 3, 4, 5, 6""", *_WH))
def q_role_playing_airports(spark, sf):
    wh = binding_warehouse(spark, sf)
    per_pair = binding_fact(spark, sf).groupBy("OriginAirportKey", "DestinationAirportKey").agg(
        F.count(F.lit(1)).alias("flights"))
    o = wh.airports.select(F.col("AirportKey").alias("OriginAirportKey"),
                           F.col("AirportCode").alias("OriginAirportCode"),
                           F.col("StateName").alias("OriginStateName"))
    d = wh.airports.select(F.col("AirportKey").alias("DestinationAirportKey"),
                           F.col("AirportCode").alias("DestinationAirportCode"),
                           F.col("StateName").alias("DestinationStateName"))
    return (per_pair.join(o, "OriginAirportKey").join(d, "DestinationAirportKey")
            .select("OriginAirportKey", "OriginAirportCode", "OriginStateName",
                    "DestinationAirportKey", "DestinationAirportCode", "DestinationStateName",
                    "flights"))


@query("missing_lookup_counts", with_staging("""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE dd.DateKey IS NULL) AS missing_date,
       COUNT(*) FILTER (WHERE da.AirlineKey IS NULL) AS missing_airline,
       COUNT(*) FILTER (WHERE o.AirportKey IS NULL) AS missing_origin,
       COUNT(*) FILTER (WHERE d.AirportKey IS NULL) AS missing_destination
FROM stg s LEFT JOIN dd ON dd.Date = s.FL_DATE
LEFT JOIN da ON da.DOTAirlineID = s.OP_CARRIER_AIRLINE_ID
LEFT JOIN dap o ON o.AirportID = s.ORIGIN_AIRPORT_ID
LEFT JOIN dap d ON d.AirportID = s.DEST_AIRPORT_ID""", *_WH))
def q_missing_lookup_counts(spark, sf):
    wh = binding_warehouse(spark, sf)
    return FT.missing_lookups(wh.staging, wh.dates, wh.airlines, wh.airports)


@query("unresolved_rows", with_staging("""
SELECT 'date' AS lookup, EXISTS (SELECT 1 FROM stg s WHERE s.FL_DATE NOT IN (SELECT Date FROM dd)) AS unresolved_exists
UNION ALL SELECT 'airline', EXISTS (SELECT 1 FROM stg s WHERE s.OP_CARRIER_AIRLINE_ID NOT IN (SELECT DOTAirlineID FROM da))
UNION ALL SELECT 'origin_airport', EXISTS (SELECT 1 FROM stg s WHERE s.ORIGIN_AIRPORT_ID NOT IN (SELECT AirportID FROM dap))
UNION ALL SELECT 'destination_airport', EXISTS (SELECT 1 FROM stg s WHERE s.DEST_AIRPORT_ID NOT IN (SELECT AirportID FROM dap))""",
    *_WH))
def q_unresolved_rows(spark, sf):
    wh = binding_warehouse(spark, sf)
    return FT.unresolved_exists(wh.staging, wh.dates, wh.airlines, wh.airports)


def staging_by_month(staging):
    return staging.groupBy(F.year("FL_DATE").cast("short").alias("Year"),
                           F.month("FL_DATE").cast("short").alias("Month")).agg(
        F.count(F.lit(1)).alias("staging_rows"))


def fact_by_month(fact_keys, dates):
    per_key = fact_keys.groupBy("DateKey").agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.join(F.broadcast(dates.select("DateKey", "Year", "Month")), "DateKey")
            .groupBy("Year", "Month").agg(F.sum("_n").cast("bigint").alias("fact_rows")))


_MONTHLY = """sm AS (SELECT CAST(year(FL_DATE) AS SMALLINT) AS Year, CAST(month(FL_DATE) AS SMALLINT) AS Month,
                    COUNT(*) AS staging_rows FROM stg GROUP BY 1, 2),
fm AS (SELECT dd.Year, dd.Month, COUNT(*) AS fact_rows FROM fb JOIN dd ON dd.DateKey = fb.DateKey
       GROUP BY 1, 2)"""


@query("fact_by_dim_month", with_staging("SELECT Year, Month, fact_rows FROM fm", *_WH, _MONTHLY))
def q_fact_by_dim_month(spark, sf):
    return fact_by_month(binding_fact(spark, sf), binding_warehouse(spark, sf).dates)


@query("monthly_reconciliation", with_staging("""
SELECT sm.Year, sm.Month, sm.staging_rows, fm.fact_rows,
       sm.staging_rows - COALESCE(fm.fact_rows, 0) AS difference,
       COALESCE(fm.fact_rows = sm.staging_rows, FALSE) AS matched
FROM sm LEFT JOIN fm ON fm.Year = sm.Year AND fm.Month = sm.Month""", *_WH, _MONTHLY))
def q_monthly_reconciliation(spark, sf):
    wh = binding_warehouse(spark, sf)
    return monthly_reconciliation(wh.staging, binding_fact(spark, sf), wh.dates)


def monthly_reconciliation(staging, fact_keys, dates):
    s = staging_by_month(staging)
    f = fact_by_month(fact_keys, dates)
    j = s.join(f, ["Year", "Month"], "left")
    return j.select("Year", "Month", "staging_rows", "fact_rows",
                    (F.col("staging_rows") - F.coalesce("fact_rows", F.lit(0))).alias("difference"),
                    F.coalesce(F.col("fact_rows") == F.col("staging_rows"), F.lit(False)).alias("matched"))


_LOOKUP_SQL = """SELECT upper(substr(r.r_name, 1, 1)) || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS Airport_Code,
       n.n_name AS Airport_Name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey"""


def airport_name_lookup(spark, sf):
    """Code -> name mapping (nation names under the airport codes of the binding)."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.upper(F.substring("r_name", 1, 1)),
                 F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("Airport_Code"),
        F.col("n_name").alias("Airport_Name"))


def with_names(dim, lookup, code_col="AirportCode", code_key="Airport_Code",
               name_key="Airport_Name", out="AirportName"):
    """Left lookup of display names; the code stands in when no name exists.
    The mapping file is bounded (one row per code), so it is broadcast."""
    return (dim.join(F.broadcast(lookup), dim[code_col] == lookup[code_key], "left")
            .withColumn(out, F.coalesce(F.col(name_key), F.col(code_col)))
            .drop(code_key, name_key))


@query("name_lookup", with_staging(f"""
SELECT dap.AirportKey, dap.AirportCode, COALESCE(m.Airport_Name, dap.AirportCode) AS AirportName
FROM dap LEFT JOIN ({_LOOKUP_SQL}) m ON m.Airport_Code = dap.AirportCode""", *_WH))
def q_name_lookup(spark, sf):
    wh = binding_warehouse(spark, sf)
    return with_names(wh.airports, airport_name_lookup(spark, sf)).select(
        "AirportKey", "AirportCode", "AirportName")


# --- the same reports on a load with known defects ---------------------------
# airports without every seventh key, and a fact without every 97th flight
_DEFECT_WH = (*_WH, "bad_dap AS (SELECT * FROM dap WHERE AirportKey % 7 <> 0)",
              "bad_fact AS (SELECT * FROM fact WHERE FlightKey % 97 <> 0)")


def _defective_airports(wh):
    return wh.airports.where("AirportKey % 7 <> 0")


def _defective_fact(spark, sf):
    return binding_fact(spark, sf).where("FlightKey % 97 <> 0")


@query("missing_lookup_counts_defective", with_staging("""
SELECT COUNT(*) FILTER (WHERE o.AirportKey IS NULL) AS missing_origin,
       COUNT(*) FILTER (WHERE d.AirportKey IS NULL) AS missing_destination, COUNT(*) AS total_rows
FROM stg s LEFT JOIN bad_dap o ON o.AirportID = s.ORIGIN_AIRPORT_ID
           LEFT JOIN bad_dap d ON d.AirportID = s.DEST_AIRPORT_ID""", *_DEFECT_WH))
def q_missing_lookup_counts_defective(spark, sf):
    wh = binding_warehouse(spark, sf)
    return FT.missing_lookups(wh.staging, wh.dates, wh.airlines, _defective_airports(wh)).select(
        "missing_origin", "missing_destination", "total_rows")


@query("monthly_reconciliation_defective", with_staging("""
SELECT sm.Year, sm.Month, sm.staging_rows, bm.fact_rows,
       sm.staging_rows - COALESCE(bm.fact_rows, 0) AS difference,
       COALESCE(bm.fact_rows = sm.staging_rows, FALSE) AS matched
FROM sm LEFT JOIN (SELECT dd.Year, dd.Month, COUNT(*) AS fact_rows
                   FROM bad_fact f JOIN dd ON dd.DateKey = f.DateKey GROUP BY 1, 2) bm
     ON bm.Year = sm.Year AND bm.Month = sm.Month""", *_DEFECT_WH, _MONTHLY))
def q_monthly_reconciliation_defective(spark, sf):
    wh = binding_warehouse(spark, sf)
    return monthly_reconciliation(wh.staging, _defective_fact(spark, sf), wh.dates)


@query("load_gates_defective", with_staging("""
SELECT 'row_reconciliation' AS "check", 50030 AS code, 'fact' AS subject,
       (SELECT COUNT(*) FROM bad_fact) AS observed, (SELECT COUNT(*) FROM stg) AS expected,
       (SELECT COUNT(*) FROM bad_fact) = (SELECT COUNT(*) FROM stg) AS passed
UNION ALL
SELECT 'referential', 50036, k.subject, k.n, 0, k.n = 0 FROM (
  SELECT 'DateKey' AS subject, CAST(0 AS BIGINT) AS n
  UNION ALL SELECT 'AirlineKey', 0
  UNION ALL SELECT 'OriginAirportKey', (SELECT COUNT(*) FROM bad_fact WHERE OriginAirportKey % 7 = 0)
  UNION ALL SELECT 'DestinationAirportKey', (SELECT COUNT(*) FROM bad_fact WHERE DestinationAirportKey % 7 = 0)) k""",
    *_DEFECT_WH))
def q_load_gates_defective(spark, sf):
    """K13 and K18 on the defective load: they must report it."""
    from flightdeck.operators import quality as Q
    wh, fact = binding_warehouse(spark, sf), _defective_fact(spark, sf)
    return Q.row_reconciliation(wh.staging, fact, code=50030).unionByName(
        Q.referential(fact, wh.dates, wh.airlines, _defective_airports(wh)))


@query("fact_flights", with_staging("SELECT * FROM fact", *_WH))
def q_fact_flights(spark, sf):
    return binding_fact(spark, sf)
