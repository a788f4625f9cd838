"""KPI measures as aggregate Columns.

Every measure is computed from additive parts (counts and sums) inside one
aggregation, and rates are derived *after* aggregation, so a measure can be
re-aggregated at any grain and never averages a rate.  Spark's partial
(map-side) aggregation makes each group-by skew-proof: a hot airport or
airline contributes one partial row per task, not all of its flights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck.functions import safe_divide


@dataclass(frozen=True)
class FlightCols:
    """Names of the measure inputs on a flight-level table."""
    cancelled: str = "is_cancelled"
    diverted: str = "is_diverted"
    dep15: str = "dep_del15"
    arr15: str = "arr_del15"
    dep_delay: str = "dep_delay"
    arr_delay: str = "arr_delay"


BINDING_COLS = FlightCols()
FACT_COLS = FlightCols(cancelled="IsCancelled", diverted="IsDiverted", dep15="IsDepDelayed15",
                       arr15="IsArrDelayed15", dep_delay="DepDelayMinutes",
                       arr_delay="ArrDelayMinutes")


def _false_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def on_time_predicate(cols: FlightCols = BINDING_COLS) -> Column:
    """Not cancelled, not diverted, not arrived 15+ late.

    An unknown arrival flag counts as "not delayed" (the report's
    ``flag = FALSE()`` filter treats BLANK as FALSE), so a completed flight
    without a known arrival delay is on time.
    """
    return (~_false_if_null(cols.arr15) & ~_false_if_null(cols.cancelled)
            & ~_false_if_null(cols.diverted))


# Additive parts: name -> aggregate expression builder.
def parts(cols: FlightCols = BINDING_COLS) -> dict[str, Column]:
    return {
        "total_flights": F.count(F.lit(1)),
        "on_time_flights": F.count_if(on_time_predicate(cols)),
        "cancelled_flights": F.count_if(_false_if_null(cols.cancelled)),
        "diverted_flights": F.count_if(_false_if_null(cols.diverted)),
        "dep_delayed15_flights": F.count_if(_false_if_null(cols.dep15)),
        "arr_delayed15_flights": F.count_if(_false_if_null(cols.arr15)),
        "dep_delay_sum": F.sum(F.col(cols.dep_delay).cast("bigint")),
        "dep_delay_n": F.count(cols.dep_delay),
        "arr_delay_sum": F.sum(F.col(cols.arr_delay).cast("bigint")),
        "arr_delay_n": F.count(cols.arr_delay),
    }


# Derived measures over the part columns of an aggregated frame.  Built on
# demand: a Column needs an active session.
def _ratio(num: str, den: str):
    return lambda: safe_divide(num, den)


def _plain(name: str):
    return lambda: F.col(name)


MEASURES = {
    "total_flights": _plain("total_flights"),
    "on_time_flights": _plain("on_time_flights"),
    "on_time_rate": _ratio("on_time_flights", "total_flights"),
    "cancelled_flights": _plain("cancelled_flights"),
    "cancellation_rate": _ratio("cancelled_flights", "total_flights"),
    "diverted_flights": _plain("diverted_flights"),
    "diversion_rate": _ratio("diverted_flights", "total_flights"),
    "dep_delayed15_flights": _plain("dep_delayed15_flights"),
    "arr_delayed15_flights": _plain("arr_delayed15_flights"),
    # Both delay rates divide by all flights, cancelled ones included.
    "dep_delay_rate": _ratio("dep_delayed15_flights", "total_flights"),
    "arr_delay_rate": _ratio("arr_delayed15_flights", "total_flights"),
    "avg_dep_delay": _ratio("dep_delay_sum", "dep_delay_n"),
    "avg_arr_delay": _ratio("arr_delay_sum", "arr_delay_n"),
}

# Direction of each measure for best/worst highlighting (True = higher is better).
HIGHER_IS_BETTER = {"on_time_rate": True, "cancellation_rate": False, "avg_arr_delay": False,
                    "avg_dep_delay": False, "diversion_rate": False, "dep_delay_rate": False,
                    "arr_delay_rate": False}


# Parts each derived measure reads (keeps every aggregation as narrow as possible).
MEASURE_PARTS: dict[str, tuple[str, ...]] = {
    "total_flights": ("total_flights",),
    "on_time_flights": ("on_time_flights",),
    "on_time_rate": ("on_time_flights", "total_flights"),
    "cancelled_flights": ("cancelled_flights",),
    "cancellation_rate": ("cancelled_flights", "total_flights"),
    "diverted_flights": ("diverted_flights",),
    "diversion_rate": ("diverted_flights", "total_flights"),
    "dep_delayed15_flights": ("dep_delayed15_flights",),
    "arr_delayed15_flights": ("arr_delayed15_flights",),
    "dep_delay_rate": ("dep_delayed15_flights", "total_flights"),
    "arr_delay_rate": ("arr_delayed15_flights", "total_flights"),
    "avg_dep_delay": ("dep_delay_sum", "dep_delay_n"),
    "avg_arr_delay": ("arr_delay_sum", "arr_delay_n"),
}


def needed_parts(measures: list[str]) -> list[str]:
    names: list[str] = []
    for m in measures:
        for p in MEASURE_PARTS[m]:
            if p not in names:
                names.append(p)
    return names


def aggregate_parts(df: DataFrame, by: list, part_names: list[str],
                    cols: FlightCols = BINDING_COLS) -> DataFrame:
    """One (partial + final) aggregation producing the additive parts.

    A table that carries the parts already (the cube) has them added up."""
    if all(p in df.columns for p in part_names):
        return rollup_parts(df, by, part_names)
    exprs = parts(cols)
    return df.groupBy(*by).agg(*[exprs[p].alias(p) for p in part_names])


def rollup_parts(df: DataFrame, by: list, part_names: list[str]) -> DataFrame:
    """Re-aggregate already aggregated parts to a coarser grain (sums only).

    Over no rows at all a count is 0, as a count of no flights is, and a sum NULL.
    """
    def total(p: str) -> Column:
        whole = F.sum(p).cast("bigint")
        return whole if p.endswith("_sum") else F.coalesce(whole, F.lit(0).cast("bigint"))
    return df.groupBy(*by).agg(*[total(p).alias(p) for p in part_names])


def derive(df: DataFrame, keep: list, measures: list[str]) -> DataFrame:
    """Select ``keep`` plus each measure computed from the part columns."""
    return df.select(*keep, *[MEASURES[m]().alias(m) for m in measures])


def aggregate(df: DataFrame, by: list, measures: list[str],
              cols: FlightCols = BINDING_COLS) -> DataFrame:
    """``groupBy(by)`` with the parts the measures need, then derive them."""
    agg = aggregate_parts(df, by, needed_parts(measures), cols)
    keys = [c for c in agg.columns if c not in needed_parts(measures)]
    return derive(agg, keys, measures)
