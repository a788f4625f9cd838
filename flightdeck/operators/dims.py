"""Dimensions: calendar, airline, role-playing airport; keep-latest / dedup;
MERGE-style upsert that preserves surrogate keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck import functions as FN
from flightdeck.operators.keys import sequential_keys

# ---------------------------------------------------------------------------
# Calendar
# ---------------------------------------------------------------------------


def date_spine(df: DataFrame, date_col: str = "FL_DATE", out: str = "Date") -> DataFrame:
    """Every day from min to max of ``date_col``, gaps included.

    The bounds are one partial/final aggregate; the explode runs on the one
    bounds row and emits one row per calendar day (bounded by the calendar,
    not by the data volume).
    """
    bounds = df.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.filter(F.col("_lo").isNotNull()).select(
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(out))


def date_spine_between(spark, first: str, last: str, out: str = "Date") -> DataFrame:
    """Calendar between two literal dates (e.g. a configured reporting year)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)),
                                                      F.to_date(F.lit(last)),
                                                      F.expr("INTERVAL 1 DAY"))).alias(out))


def dim_date(spine: DataFrame, date_col: str = "Date") -> DataFrame:
    """The 12 calendar columns keyed by the smart key ``DateKey``."""
    d = F.col(date_col)
    parts = FN.date_parts(d)
    names = FN.date_names(d)
    return spine.select(
        FN.date_key(d).alias("DateKey"), d.alias("Date"), parts["Year"].alias("Year"),
        parts["Quarter"].alias("Quarter"), names["QuarterName"].alias("QuarterName"),
        parts["Month"].alias("Month"), names["MonthName"].alias("MonthName"),
        FN.year_month_key(d).alias("YearMonth"), parts["DayOfMonth"].alias("DayOfMonth"),
        FN.iso_weekday(d).alias("DayOfWeek"), names["DayName"].alias("DayName"),
        FN.is_weekend(d).alias("IsWeekend"))


# ---------------------------------------------------------------------------
# One row per business key
# ---------------------------------------------------------------------------


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """Per key, the values of the row that sorts first under ``order``.

    ``min(struct(order..., values...))`` is an ordinary aggregate: partial per
    task, then final, so a key holding a third of all rows still contributes
    one row per task to the shuffle.  ``order`` should be total; values are
    appended as the final tie-break so reruns agree.
    """
    ordered = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.min(F.struct(*ordered, *[F.col(v) for v in values])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def airline_source(staging: DataFrame) -> DataFrame:
    return staging.select(F.col("OP_CARRIER_AIRLINE_ID").alias("DOTAirlineID"),
                          F.col("OP_UNIQUE_CARRIER").alias("UniqueCarrierCode"),
                          F.col("OP_CARRIER").alias("CarrierCode"))


def airline_current(staging: DataFrame) -> DataFrame:
    """One row per DOT airline id: the lowest (unique carrier, carrier) pair."""
    # distinct rows first: they are hashed, the least struct of a key is found by sorting
    src = airline_source(staging).dropna(subset=["DOTAirlineID", "UniqueCarrierCode", "CarrierCode"]).distinct()
    return first_per_key(src, ["DOTAirlineID"], [F.col("UniqueCarrierCode"), F.col("CarrierCode")],
                         ["UniqueCarrierCode", "CarrierCode"])


AIRPORT_ATTRS = ("AirportSeqID", "AirportCode", "CityName", "CityMarketID", "StateCode",
                 "StateName", "WorldAreaCode")
AIRPORT_REQUIRED = ("AirportID", "AirportCode", "CityName", "StateCode", "StateName")


def airport_union(staging: DataFrame) -> DataFrame:
    """Origin and destination attribute sets in one shape (UNION ALL)."""
    def side(p: str, code: str) -> DataFrame:
        return staging.select(
            F.col(f"{p}_AIRPORT_ID").alias("AirportID"),
            F.col(f"{p}_AIRPORT_SEQ_ID").alias("AirportSeqID"),
            F.col(code).alias("AirportCode"), F.col(f"{p}_CITY_NAME").alias("CityName"),
            F.col(f"{p}_CITY_MARKET_ID").alias("CityMarketID"),
            F.col(f"{p}_STATE_ABR").alias("StateCode"), F.col(f"{p}_STATE_NM").alias("StateName"),
            F.col(f"{p}_WAC").alias("WorldAreaCode"))
    return side("ORIGIN", "ORIGIN").unionByName(side("DEST", "DEST"))


def airport_current(staging: DataFrame) -> DataFrame:
    """One row per AirportID: the highest AirportSeqID (NULL last), ties broken
    ascending on code, city, market, state code, state name, world area code."""
    src = airport_union(staging).dropna(subset=list(AIRPORT_REQUIRED)).distinct()
    seq = F.col("AirportSeqID")
    order = [seq.isNull(), F.lit(0) - seq.cast("bigint"), F.col("AirportCode"), F.col("CityName"), F.col("CityMarketID"),
             F.col("StateCode"), F.col("StateName"), F.col("WorldAreaCode")]
    return first_per_key(src, ["AirportID"], order, list(AIRPORT_ATTRS))


# ---------------------------------------------------------------------------
# Upsert (MERGE without a MERGE-capable table format)
# ---------------------------------------------------------------------------


def attrs_changed(attrs: list[str]) -> Callable[[Column, Column], Column]:
    """Update predicate: any attribute differs (NULL-safe)."""
    def pred(t: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
        out = F.lit(False)
        for a in attrs:
            out = out | ~t(a).eqNullSafe(s(a))
        return out
    return pred


def upsert(target: DataFrame, source: DataFrame, keys: list[str], attrs: list[str],
           key_col: str | None = None, update_when=None,
           new_key: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Merge ``source`` into ``target`` on business ``keys``; never deletes.

    * matched and ``update_when(t, s)`` (default: always) -> source attributes,
      target surrogate key kept, ``_action = 'update'``;
    * matched otherwise -> target row, ``'keep'``;
    * target only -> ``'keep'``;
    * source only -> ``'insert'``: ``key_col`` = max(existing key) + 1, 2, ...
      in business-key order (or ``new_key(row)`` when given, e.g. a smart key).

    The maximum existing key is a scalar subquery; new keys are numbered with
    :func:`sequential_keys` (no single-partition window).  The merged rows are
    checkpointed once, so the source is evaluated once.

    A source that has a business key twice is ambiguous: the merge raises, as
    MERGE does.
    """
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns])
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    once = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(a).alias(a) for a in attrs])
    once = once.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("upsert source has a key more than once: "), named)).cast("boolean")))
    s = once.select(*[F.col(c).alias(f"_s_{c}") for c in keys + attrs])
    cond = None
    for k in keys:
        e = F.col(f"_t_{k}") == F.col(f"_s_{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    tcol = lambda c: F.col(f"_t_{c}")
    scol = lambda c: F.col(f"_s_{c}")
    in_t = tcol(keys[0]).isNotNull()
    in_s = scol(keys[0]).isNotNull()
    upd = F.lit(True) if update_when is None else F.coalesce(update_when(tcol, scol), F.lit(False))
    action = (F.when(in_t & in_s & upd, F.lit("update")).when(in_t, F.lit("keep"))
              .otherwise(F.lit("insert")))
    j = j.withColumn("_action", action)
    out_cols = []
    for k in keys:
        out_cols.append(F.coalesce(tcol(k), scol(k)).alias(k))
    for a in attrs:
        out_cols.append(F.when(F.col("_action") == "keep", tcol(a)).otherwise(scol(a)).alias(a))
    cols = [key_col] if key_col else []
    merged = j.select(*[tcol(c).alias(c) for c in cols], *out_cols, "_action")
    if not key_col:
        return merged
    # Both branches below read the merge result; materialise it once (it is
    # dimension-sized) so the source -- usually an aggregation over every
    # staging row -- is evaluated once, and a lost executor re-reads files.
    from flightdeck.session import checkpoint_root
    checkpoint_root(merged.sparkSession)
    merged = merged.checkpoint(eager=True)
    existing = merged.filter(F.col("_action") != "insert")
    inserted = merged.filter(F.col("_action") == "insert").drop(key_col)
    if new_key is not None:
        inserted = inserted.withColumn(key_col, new_key(inserted))
    else:
        # the largest existing key as a scalar subquery (no driver round trip)
        max_key = F.coalesce(target.select(F.max(key_col).cast("bigint")).scalar(),
                             F.lit(0).cast("bigint"))
        inserted = sequential_keys(inserted, keys, key_col, start=max_key)
    key_type = target.schema[key_col].dataType
    inserted = inserted.withColumn(key_col, F.col(key_col).cast(key_type))
    return existing.unionByName(inserted.select(*existing.columns))


def initial_keys(df: DataFrame, keys: list[str], key_col: str, key_type: str = "int") -> DataFrame:
    """First load: IDENTITY(1,1) over the business-key order."""
    out = sequential_keys(df, keys, key_col, start=0)
    return out.select(F.col(key_col).cast(key_type).alias(key_col), *df.columns)


def dim_airline(staging: DataFrame) -> DataFrame:
    cur = airline_current(staging)
    return initial_keys(cur, ["DOTAirlineID"], "AirlineKey")


def dim_airport(staging: DataFrame) -> DataFrame:
    cur = airport_current(staging)
    return initial_keys(cur, ["AirportID"], "AirportKey")
