"""Report visuals: filter context, grouped KPIs, top-N and highlights.

Shape of every visual: apply the slicer context on the flights (semi-joins
against the fixed-size airport dimension for state slicers), aggregate the
additive parts at the visual's grain, attach labels from the dimensions
*after* aggregation (the join then touches a few hundred rows instead of every
flight), derive the rates, then order / cut to top-N / add best-worst flags.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightdeck.functions import route_label, year_month_key
from flightdeck.operators import measures as M
from flightdeck.operators.cube import Star
from flightdeck.sinks.tables import store


@dataclass(frozen=True)
class FilterContext:
    """Slicer selection: AND across slicers, OR inside one, empty = all."""
    months: tuple[int, ...] = ()
    airlines: tuple[str, ...] = ()
    origin_states: tuple[str, ...] = ()
    dest_states: tuple[str, ...] = ()

    @property
    def roles(self) -> set[str]:
        """The dimensions that the selection filters."""
        chosen = {"date": self.months, "airline": self.airlines, "origin": self.origin_states, "dest": self.dest_states}
        return {role for role, values in chosen.items() if values}

    @property
    def is_filtered(self) -> bool:
        return bool(self.months or self.airlines or self.origin_states or self.dest_states)


NO_FILTER = FilterContext()


def apply_context(flights: DataFrame | Star, airports: DataFrame, ctx: FilterContext,
                  date_col: str = "fl_date", airline_col: str = "op_unique_carrier",
                  origin_col: str = "origin_airport_id",
                  dest_col: str = "dest_airport_id", needs: tuple[str, ...] = ()) -> DataFrame:
    """Restrict flights to the slicer selection.

    ``flights`` is a flight-level table or the star, which joins the dimensions that
    the selection filters and those in ``needs``.  Month and airline are plain
    predicates (on the star they reach the dimensions); state slicers become left-semi
    joins with the airport dimension restricted to the chosen states.
    """
    df = flights.flights(ctx.roles | set(needs)) if isinstance(flights, Star) else flights
    if ctx.months:
        df = df.filter(F.month(date_col).isin(list(ctx.months)))
    if ctx.airlines:
        df = df.filter(F.col(airline_col).isin(list(ctx.airlines)))
    for states, col in ((ctx.origin_states, origin_col), (ctx.dest_states, dest_col)):
        if states:
            keys = airports.filter(F.col("state_name").isin(list(states))).select(
                F.col("airport_id").alias(col))
            df = df.join(keys, col, "left_semi")
    return df


def with_airport(df: DataFrame, airports: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """Role-playing lookup: attach ``{prefix}_code`` / ``{prefix}_state`` for ``id_col``."""
    role = airports.select(F.col("airport_id").alias(id_col),
                           F.col("airport_code").alias(f"{prefix}_code"),
                           F.col("state_name").alias(f"{prefix}_state"))
    return df.join(role, id_col, "left")


def kpis(flights: DataFrame, airports: DataFrame, ctx: FilterContext, by: list,
         measures: list[str]) -> DataFrame:
    """Generic visual: context -> aggregate at ``by`` -> derived measures."""
    return M.aggregate(apply_context(flights, airports, ctx), by, measures)


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Exact top-N under a total order (``TakeOrderedAndProject``: every task
    keeps its own best N, the driver merges N x tasks rows)."""
    return df.orderBy(*order).limit(n)


def top_n_with_ties(df: DataFrame, n: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Top-N that keeps every row tied with the N-th (may return more than N).

    ``rank() <= n`` over a global order; Catalyst inserts a WindowGroupLimit so
    each task forwards at most its own top-N (plus ties) before the single
    ranking partition.  Meant for aggregated rows.
    """
    w = Window.orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)


def extreme(df: DataFrame, measure: str, fn=F.max) -> Column:
    """``fn(measure)`` over all rows of ``df`` as a scalar-subquery column.

    The extreme is a distributed partial + final aggregate evaluated once as
    an uncorrelated scalar subquery and handed to the tasks as a value: no
    single-partition window, no join, however many rows ``df`` has (Spark
    merges subqueries over the same plan and reuses its exchange)."""
    return df.select(fn(measure)).scalar()


def highlight(df: DataFrame, measure: str, higher_is_better: bool | None = None,
              out: str | None = None) -> DataFrame:
    """Best / worst flag over the visible rows.

    The maximum is tested first, so when every row has the same value the max
    branch wins.  The extremes are scalar subqueries over ``df``.
    """
    if higher_is_better is None:
        higher_is_better = M.HIGHER_IS_BETTER[measure]
    out = out or f"{measure}_highlight"
    m = F.col(measure)
    hi, lo = ("BEST", "WORST") if higher_is_better else ("WORST", "BEST")
    return df.withColumn(out, F.when(m == extreme(df, measure, F.max), F.lit(hi))
                         .when(m == extreme(df, measure, F.min), F.lit(lo))
                         .otherwise(F.lit(None).cast("string")))


def share_of_max(df: DataFrame, measure: str = "total_flights",
                 out: str = "volume_share") -> DataFrame:
    """Neutral data-bar encoding: value / max(value) over the visible rows."""
    return df.withColumn(out, F.try_divide(F.col(measure).cast("double"),
                                           extreme(df, measure, F.max).cast("double")))


# ---------------------------------------------------------------------------
# Visuals.  Output keys: airline, origin_code, route, year_month/month_name.
# ---------------------------------------------------------------------------

OVERVIEW_MEASURES = ["total_flights", "on_time_rate", "cancellation_rate", "dep_delay_rate",
                     "arr_delay_rate", "avg_arr_delay"]
OPERATIONS_MEASURES = ["diversion_rate", "avg_arr_delay", "cancellation_rate", "dep_delay_rate"]
MATRIX_MEASURES = ["total_flights", "on_time_rate", "cancellation_rate", "avg_arr_delay"]


def cards(flights, airports, ctx=NO_FILTER, measures=OVERVIEW_MEASURES) -> DataFrame:
    return kpis(flights, airports, ctx, [], measures)


def monthly(flights, airports, ctx=NO_FILTER, measures=("on_time_rate",),
            date_col: str = "fl_date") -> DataFrame:
    """Per calendar month; keyed by ``year_month`` so several years never merge.

    The month name is attached after aggregation from the key (sort-by-column:
    the label sorts by ``year_month``).
    """
    measures = list(measures)
    df = apply_context(flights, airports, ctx, needs=("date",)).withColumn("year_month", year_month_key(date_col))
    agg = M.aggregate(df, ["year_month"], measures)
    label = F.date_format(F.to_date(F.concat(F.col("year_month").cast("string"), F.lit("01")),
                                    "yyyyMMdd"), "MMMM")
    return agg.select("year_month", label.alias("month_name"), *measures).orderBy("year_month")


def by_airline(flights, airports, ctx=NO_FILTER, measures=("total_flights", "on_time_rate"),
               airline_col: str = "op_unique_carrier") -> DataFrame:
    measures = list(measures)
    df = apply_context(flights, airports, ctx, needs=("airline",))
    return M.aggregate(df.withColumnRenamed(airline_col, "airline"), ["airline"], measures)


def by_origin(flights, airports, ctx=NO_FILTER, measures=("total_flights",)) -> DataFrame:
    """Per origin airport code: parts by airport id, label, re-aggregate by code."""
    measures = list(measures)
    need = M.needed_parts(measures)
    parts = M.aggregate_parts(apply_context(flights, airports, ctx, needs=("origin",)), ["origin_airport_id"], need)
    labelled = with_airport(parts, airports, "origin_airport_id", "origin")
    by_code = M.rollup_parts(labelled, ["origin_code"], need)
    return M.derive(by_code, ["origin_code"], measures)


def by_route(flights, airports, ctx=NO_FILTER, measures=("total_flights", "on_time_rate")) -> DataFrame:
    """Per route (origin code -> destination code) with its label."""
    measures = list(measures)
    need = M.needed_parts(measures)
    parts = M.aggregate_parts(apply_context(flights, airports, ctx, needs=("origin", "dest")),
                              ["origin_airport_id", "dest_airport_id"], need)
    labelled = with_airport(with_airport(parts, airports, "origin_airport_id", "origin"),
                            airports, "dest_airport_id", "dest")
    by_code = M.rollup_parts(labelled, ["origin_code", "dest_code"], need)
    by_code = by_code.withColumn("route", route_label("origin_code", "dest_code"))
    return M.derive(by_code, ["route", "origin_code", "dest_code"], measures)


def busiest_routes(flights, airports, ctx=NO_FILTER, n: int = 10) -> DataFrame:
    """Top-N routes by volume first (tie-break on the label), then their rate."""
    routes = by_route(flights, airports, ctx, ["total_flights", "on_time_rate"])
    top = top_n(routes, n, [F.desc("total_flights"), F.asc("route")])
    return top.orderBy(F.desc("on_time_rate"), F.desc("total_flights"), F.asc("route"))


def routes_min_volume(flights, airports, ctx=NO_FILTER, min_flights: int = 1) -> DataFrame:
    """Route ranking by rate restricted to routes with enough flights."""
    routes = by_route(flights, airports, ctx, ["total_flights", "on_time_rate"])
    kept = routes.filter(F.col("total_flights") >= min_flights)
    return ranked(kept, "on_time_rate", "otr_rank")


def ranked(df: DataFrame, measure: str, out: str) -> DataFrame:
    """``rank()`` by ``measure`` (descending, NULL last) without a window over all rows.

    Rows are counted per distinct value, the values dealt by ranges and numbered inside
    each range, and the ranges' totals (one row a partition) added up; a value's rank is
    one more than the rows of all greater values.  Ties share a rank.
    """
    by = F.desc_nulls_last(measure)
    values = store(df.groupBy(measure).agg(F.count(F.lit(1)).alias("_n")), "rank-values")
    ranges = store(values.repartitionByRange(by).withColumn("_range", F.spark_partition_id()), "rank-ranges")
    totals = ranges.groupBy("_range").agg(F.sum("_n").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_range").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ranges.join(F.broadcast(offsets), "_range").select(
        F.col(measure).alias("_value"),
        (F.col("_off") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1).cast("int").alias(out))
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_value"))).drop("_value")


def benchmark_delta(current: DataFrame, ctx: FilterContext, prior_rate: float,
                    measure: str = "on_time_rate") -> DataFrame:
    """Comparison with a prior-period rate, shown only without slicers.

    ``delta_pp`` is the difference in percentage points; ``trend`` is UP /
    DOWN / FLAT and both are NULL whenever any slicer is active.
    """
    delta = (F.col(measure) - F.lit(prior_rate)) * 100
    if ctx.is_filtered:
        delta = F.lit(None).cast("double")
    trend = (F.when(delta > 0, F.lit("UP")).when(delta < 0, F.lit("DOWN"))
             .when(delta == 0, F.lit("FLAT")))
    return current.select(measure, F.lit(prior_rate).alias("prior_rate"),
                          delta.alias("delta_pp"), trend.alias("trend"))
