"""Flight fact: key resolution, projection, surrogate keys, lookup checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightdeck.operators.keys import numbered_by_group
from flightdeck.schemas import FACT_GRAIN, FACT_KEYS, fact_projection_spec


def project_fact_columns(staging: DataFrame) -> list:
    """Staging -> fact renames and casts (0/1 flags become booleans)."""
    return [F.col(src).cast(t).alias(dst) for src, dst, t in fact_projection_spec()]


def _dims(dates: DataFrame, airlines: DataFrame, airports: DataFrame):
    # The calendar is bounded by the number of days covered (366 a year), so it
    # is broadcast outright.  Airline and airport dimensions are joined without
    # a hint: Spark broadcasts them when their measured size is under the
    # threshold (at runtime with AQE) and falls back to a sort-merge join.
    d = F.broadcast(dates.select("DateKey", F.col("Date").alias("_date")))
    a = airlines.select("AirlineKey", F.col("DOTAirlineID").alias("_airline_id"))
    o = airports.select(F.col("AirportKey").alias("OriginAirportKey"),
                        F.col("AirportID").alias("_origin_id"))
    t = airports.select(F.col("AirportKey").alias("DestinationAirportKey"),
                        F.col("AirportID").alias("_dest_id"))
    return d, a, o, t


def resolve_keys(staging: DataFrame, dates: DataFrame, airlines: DataFrame,
                 airports: DataFrame, how: str = "inner") -> DataFrame:
    """Staging rows with the four surrogate keys (business keys -> keys)."""
    d, a, o, t = _dims(dates, airlines, airports)
    return (staging
            .join(d, F.col("FL_DATE") == F.col("_date"), how)
            .join(a, F.col("OP_CARRIER_AIRLINE_ID") == F.col("_airline_id"), how)
            .join(o, F.col("ORIGIN_AIRPORT_ID") == F.col("_origin_id"), how)
            .join(t, F.col("DEST_AIRPORT_ID") == F.col("_dest_id"), how)
            .drop("_date", "_airline_id", "_origin_id", "_dest_id"))


def fact_flights(staging: DataFrame, dates: DataFrame, airlines: DataFrame,
                 airports: DataFrame) -> DataFrame:
    """Full fact build: inner key resolution, projection, ``FlightKey`` in grain
    order (equal to a global row number, computed from counts per date).  The rows are
    not stored: ``staging`` is read for the counts, and by whoever reads the fact."""
    resolved = resolve_keys(staging, dates, airlines, airports, "inner")
    body = resolved.select(*[F.col(k) for k in FACT_KEYS], *project_fact_columns(resolved))
    keyed = numbered_by_group(body, list(FACT_GRAIN), "FlightKey")
    return keyed.select("FlightKey", *body.columns)


def missing_lookups(staging: DataFrame, dates: DataFrame, airlines: DataFrame,
                    airports: DataFrame) -> DataFrame:
    """Rows and unresolved lookups per dimension, one left-join pass.

    Output columns: ``total_rows, missing_date, missing_airline,
    missing_origin, missing_destination``.
    """
    keys_only = staging.select("FL_DATE", "OP_CARRIER_AIRLINE_ID", "ORIGIN_AIRPORT_ID",
                               "DEST_AIRPORT_ID")
    r = resolve_keys(keys_only, dates, airlines, airports, "left")
    return r.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(F.col("DateKey").isNull()).alias("missing_date"),
                 F.count_if(F.col("AirlineKey").isNull()).alias("missing_airline"),
                 F.count_if(F.col("OriginAirportKey").isNull()).alias("missing_origin"),
                 F.count_if(F.col("DestinationAirportKey").isNull()).alias("missing_destination"))


def unresolved_exists(staging: DataFrame, dates: DataFrame, airlines: DataFrame,
                      airports: DataFrame) -> DataFrame:
    """Per dimension: does any staging row lack a match (anti-join + limit 1)."""
    spark = staging.sparkSession
    checks = [
        ("date", "FL_DATE", dates.select(F.col("Date").alias("_k"))),
        ("airline", "OP_CARRIER_AIRLINE_ID", airlines.select(F.col("DOTAirlineID").alias("_k"))),
        ("origin_airport", "ORIGIN_AIRPORT_ID", airports.select(F.col("AirportID").alias("_k"))),
        ("destination_airport", "DEST_AIRPORT_ID", airports.select(F.col("AirportID").alias("_k"))),
    ]
    out = None
    for name, col, dim in checks:
        miss = (staging.select(F.col(col).alias("_k")).join(dim, "_k", "left_anti").limit(1)
                .agg(F.count(F.lit(1)).alias("_n")))
        one = miss.select(F.lit(name).alias("lookup"), (F.col("_n") > 0).alias("unresolved_exists"))
        out = one if out is None else out.unionByName(one)
    return out
