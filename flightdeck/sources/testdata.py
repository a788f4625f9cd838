"""Binding of the driver's TPC-H-style test tables to the flight model.

The test tables hold no flights, so every operator is parameterised by column
names and runs on this derived view:

* a flight is a ``lineitem`` row, its date the ship date;
* the airline is the supplier (id ``s_suppkey``, carrier code ``s_name``);
* the flight number is the part key;
* the origin airport is the supplier's nation, the destination airport the
  customer's nation; airport code / city = nation name, state = region name;
* the scheduled departure clock is derived from the order key as HHMM
  (``orderkey % 1440`` minutes, 0 written as 2400);
* cancelled = return flag R, line status F, line number <= 2;
  diverted = return flag A, line status F, line number 3;
* departure delay = ``partkey % 60 - 15`` (NULL when cancelled), arrival
  delay = ``quantity - 25`` (NULL when cancelled or diverted); the 15-minute
  flags are ``delay >= 15`` with NULL kept.

``lineitem`` -> ``orders`` -> ``customer`` are equi-joins on their keys.  The
sizes of orders, customer and supplier grow with the data, so no broadcast is
forced: Spark broadcasts a side only when its measured size is below
``autoBroadcastJoinThreshold`` (statically or, with AQE, at runtime) and
otherwise plans a sort-merge join whose skewed partitions AQE splits.
``nation`` and ``region`` have a fixed size (25 and 5 rows at every scale
factor), so the airport dimension is broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.functions import hhmm_to_time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Columns of the flight binding, in output order.
FLIGHT_COLUMNS = ("fl_date", "op_carrier_airline_id", "op_unique_carrier", "op_carrier_fl_num",
                  "origin_airport_id", "dest_airport_id", "crs_dep_hhmm", "crs_dep_time",
                  "is_cancelled", "is_diverted", "dep_delay", "arr_delay", "dep_del15",
                  "arr_del15", "order_key", "line_number")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items hash-partitioned on the order key.

    This is the distribution the sort-merge join with ``orders`` requires
    anyway (so at scale it replaces that join's exchange rather than adding
    one), and it spreads the per-row derivations over all cores even when
    the source is a single unsplittable file.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    return li.repartition("l_orderkey")


#: Columns the stored flight rows are laid out by.
BASE_LAYOUT = ("YEAR", "MONTH")


def flight_rows_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined source columns of a flight, narrow: keys, codes and the ship date."""
    li = _lineitem_by_order(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    day = F.to_date("l_shipdate")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(customer, F.col("o_custkey") == customer.c_custkey)
              .join(supplier, li.l_suppkey == supplier.s_suppkey)
              .drop("o_orderkey", "o_custkey")
              .withColumns({"YEAR": F.year(day), "MONTH": F.month(day)}))


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows, stored once per session by month; what is rendered from them is not.

    The joins run once, a few dozen bytes a row are written, and each reader renders
    the columns it needs.  A task of a later scan holds the rows of few months.
    """
    from flightdeck.sinks.tables import stored
    return stored(spark, f"flight-rows:{sf_dir}", lambda: flight_rows_view(spark, sf_dir), "flight-rows", BASE_LAYOUT)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight-level table the report visuals read (stored once per session)."""
    from flightdeck.sinks.tables import stored
    return stored(spark, f"flights:{sf_dir}", lambda: flights_view(spark, sf_dir), "flights")


def flights_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight-level view derived from the test tables."""
    joined = flight_rows(spark, sf_dir)

    cancelled = ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
                 & (F.col("l_linenumber") <= 2))
    diverted = ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
                & (F.col("l_linenumber") == 3))
    minute_of_day = F.col("l_orderkey") % 1440
    crs_hhmm = (F.when(minute_of_day == 0, F.lit(2400).cast("bigint"))
                .otherwise(F.floor(minute_of_day / 60) * 100 + F.col("l_orderkey") % 60))
    dep_delay = F.when(cancelled, F.lit(None)).otherwise(
        (F.col("l_partkey") % 60).cast("int") - 15)
    arr_delay = F.when(cancelled | diverted, F.lit(None)).otherwise(
        F.floor("l_quantity").cast("int") - 25)

    out = joined.select(
        F.to_date("l_shipdate").alias("fl_date"),
        F.col("l_suppkey").alias("op_carrier_airline_id"),
        F.col("s_name").alias("op_unique_carrier"),
        F.col("l_partkey").alias("op_carrier_fl_num"),
        F.col("s_nationkey").alias("origin_airport_id"),
        F.col("c_nationkey").alias("dest_airport_id"),
        crs_hhmm.alias("crs_dep_hhmm"),
        cancelled.alias("is_cancelled"),
        diverted.alias("is_diverted"),
        dep_delay.cast("int").alias("dep_delay"),
        arr_delay.cast("int").alias("arr_delay"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )
    return out.select(
        "fl_date", "op_carrier_airline_id", "op_unique_carrier", "op_carrier_fl_num",
        "origin_airport_id", "dest_airport_id", "crs_dep_hhmm",
        hhmm_to_time("crs_dep_hhmm").alias("crs_dep_time"),
        "is_cancelled", "is_diverted", "dep_delay", "arr_delay",
        (F.col("dep_delay") >= 15).alias("dep_del15"),
        (F.col("arr_delay") >= 15).alias("arr_del15"),
        "order_key", "line_number")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension of the report: one row per nation (fixed 25 rows)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    dim = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("airport_id"),
        F.col("n_name").alias("airport_code"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("state_name"))
    return F.broadcast(dim)


# ---------------------------------------------------------------------------
# Raw monthly-file binding: the same flights rendered as the 62 text columns
# of a raw on-time file, so the whole pipeline (clean -> staging -> dims ->
# fact -> gates) runs on the driver's tables.  Conventions of the raw files
# are kept: dates as ``M/d/yyyy 12:00:00 AM``, clocks as HHMM numbers (0 ->
# 2400), delays with a ``.0`` suffix, blank = NULL, and the text ``NA`` for
# some unknown tail numbers (order key divisible by 97).
# ---------------------------------------------------------------------------

def _hhmm_text(minutes):
    """Minute of day (0..1439) -> HHMM text, midnight written as 2400."""
    return F.when(minutes == 0, F.lit("2400")).otherwise(
        (F.floor(minutes / 60) * 100 + minutes % 60).cast("string"))


def _block(minutes):
    h = F.lpad(F.floor(minutes / 60).cast("string"), 2, "0")
    return F.concat(h, F.lit("00-"), h, F.lit("59"))


def _text(c):
    return c.cast("string")


def _code(side):
    """3-letter airport code: region initial + two-digit nation key."""
    return F.concat(F.upper(F.substring(f"{side}_r_name", 1, 1)),
                    F.lpad(F.col(f"{side}_n_nationkey").cast("string"), 2, "0"))


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw monthly rows of the binding as text.

    A view over the stored narrow rows: a reader pays for the columns it reads, and
    no 62 text columns are kept on disk.
    """
    return raw_flights_view(spark, sf_dir)


def raw_flights_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """62 all-text columns in file order (see schemas.STAGING_COLUMNS)."""
    geo = (table(spark, sf_dir, "nation")
           .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    o_geo = F.broadcast(geo.select(*[F.col(c).alias("o_" + c) for c in geo.columns]))
    d_geo = F.broadcast(geo.select(*[F.col(c).alias("d_" + c) for c in geo.columns]))

    j = (flight_rows(spark, sf_dir)
           .join(o_geo, F.col("s_nationkey") == F.col("o_n_nationkey"))
           .join(d_geo, F.col("c_nationkey") == F.col("d_n_nationkey")))

    canc = ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
            & (F.col("l_linenumber") <= 2))
    div = ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
           & (F.col("l_linenumber") == 3))
    gone = canc | div
    d = F.to_date("l_shipdate")
    dep_min = F.col("l_orderkey") % 1440
    dep_delay = F.when(~canc, (F.col("l_partkey") % 60).cast("int") - 15)
    arr_delay = F.when(~gone, F.floor("l_quantity").cast("int") - 25)
    crs_elapsed = (F.col("l_partkey") % 240 + 90).cast("int")
    taxi_out = F.when(~canc, F.col("l_linenumber") * 3 + 5)
    taxi_in = F.when(~gone, F.col("l_linenumber") + 4)
    arr_min = (dep_min + crs_elapsed) % 1440
    actual_elapsed = F.when(~gone, crs_elapsed + arr_delay - dep_delay)
    distance = F.col("l_partkey") % 2400 + 100
    late = F.coalesce(arr_delay >= 15, F.lit(False))

    def nz(flag, value):
        return F.when(flag, value)

    cols = [
        _text(F.col("YEAR")), _text(F.quarter(d)), _text(F.col("MONTH")), _text(F.dayofmonth(d)),
        _text(F.weekday(d) + 1),
        F.concat(F.date_format(d, "M/d/yyyy"), F.lit(" 12:00:00 AM")),
        F.col("s_name"), _text(F.col("l_suppkey")), F.col("s_name"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("NA"))
         .when(~canc, F.concat(F.lit("N"), _text(F.col("l_partkey") % 1000))),
        _text(F.col("l_partkey")),
        # origin airport = supplier nation, one sequence id per supplier
        _text(F.col("s_nationkey")),
        _text(F.col("s_nationkey") * 100000 + F.col("s_suppkey") % 100000),
        _text(F.col("s_nationkey") + 30000),
        _code("o"),
        F.concat(F.col("o_n_name"), F.lit(", "), F.col("o_r_name")),
        F.upper(F.substring("o_r_name", 1, 2)), F.col("o_r_name"),
        _text(F.col("s_nationkey") + 100),
        # destination airport = customer nation, one sequence id per customer
        _text(F.col("c_nationkey")),
        _text(F.col("c_nationkey") * 100000 + F.col("c_custkey") % 100000),
        _text(F.col("c_nationkey") + 30000),
        _code("d"),
        F.concat(F.col("d_n_name"), F.lit(", "), F.col("d_r_name")),
        F.upper(F.substring("d_r_name", 1, 2)), F.col("d_r_name"),
        _text(F.col("c_nationkey") + 100),
        # departure
        _hhmm_text(dep_min),
        nz(~canc, F.concat(_hhmm_text((dep_min + dep_delay + 1440) % 1440), F.lit(".0"))),
        nz(~canc, F.concat(_text(dep_delay), F.lit(".0"))),
        nz(~canc, F.concat(_text(F.greatest(dep_delay, F.lit(0))), F.lit(".0"))),
        nz(~canc, F.concat(_text((dep_delay >= 15).cast("int")), F.lit(".0"))),
        _block(dep_min),
        nz(~canc, F.concat(_text(taxi_out), F.lit(".0"))),
        nz(~canc, F.concat(_hhmm_text((dep_min + dep_delay + taxi_out + 1440) % 1440),
                           F.lit(".0"))),
        nz(~gone, F.concat(_hhmm_text((arr_min + arr_delay - taxi_in + 2880) % 1440),
                           F.lit(".0"))),
        nz(~gone, F.concat(_text(taxi_in), F.lit(".0"))),
        # arrival
        _hhmm_text(arr_min),
        nz(~gone, F.concat(_hhmm_text((arr_min + arr_delay + 1440) % 1440), F.lit(".0"))),
        nz(~gone, F.concat(_text(arr_delay), F.lit(".0"))),
        nz(~gone, F.concat(_text(F.greatest(arr_delay, F.lit(0))), F.lit(".0"))),
        nz(~gone, F.concat(_text((arr_delay >= 15).cast("int")), F.lit(".0"))),
        _block(arr_min),
        # status
        F.when(canc, F.lit("1")).otherwise(F.lit("0")),
        nz(canc, F.when(F.col("l_linenumber") == 1, F.lit("A")).otherwise(F.lit("B"))),
        F.when(div, F.lit("1")).otherwise(F.lit("0")),
        _text(crs_elapsed),
        nz(~gone, F.concat(_text(actual_elapsed), F.lit(".0"))),
        nz(~gone, F.concat(_text(actual_elapsed - taxi_out - taxi_in), F.lit(".0"))),
        _text(distance),
        # delay causes only for arrivals 15+ late
        nz(late, F.concat(_text(arr_delay - 15), F.lit(".0"))),
        nz(late, F.lit("0.0")), nz(late, F.lit("15.0")), nz(late, F.lit("0.0")),
        nz(late, F.lit("0.0")),
        # diversion
        F.when(div, F.lit("1")).otherwise(F.lit("0")),
        nz(div, F.lit("1")),
        nz(div, F.concat(_text(crs_elapsed + 30), F.lit(".0"))),
        nz(div, F.concat(_text(F.col("l_partkey") % 60 + 30), F.lit(".0"))),
        nz(div, F.concat(_text(distance + 50), F.lit(".0"))),
        nz(div, _code("d")),
        nz(div, F.concat(_text(F.col("c_nationkey")), F.lit(".0"))),
    ]
    from flightdeck.schemas import STAGING_NAMES
    assert len(cols) == len(STAGING_NAMES)
    return j.select(*[c.cast("string").alias(n) for c, n in zip(cols, STAGING_NAMES)])
