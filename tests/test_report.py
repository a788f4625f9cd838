"""Measures, filter context, top-N, highlights (incl. the BLANK traps)."""

from pyspark.sql import functions as F

from flightdeck.operators import measures as M
from flightdeck.operators import report as R

FLIGHT_SCHEMA = ("fl_date date, op_unique_carrier string, origin_airport_id int, "
                 "dest_airport_id int, is_cancelled boolean, is_diverted boolean, "
                 "dep_delay int, arr_delay int, dep_del15 boolean, arr_del15 boolean")


def flights_df(spark, rows):
    df = spark.createDataFrame(rows, "d string, a string, o int, t int, c boolean, v boolean, "
                                     "dd int, ad int")
    return df.select(F.to_date("d").alias("fl_date"), F.col("a").alias("op_unique_carrier"),
                     F.col("o").alias("origin_airport_id"), F.col("t").alias("dest_airport_id"),
                     F.col("c").alias("is_cancelled"), F.col("v").alias("is_diverted"),
                     F.col("dd").alias("dep_delay"), F.col("ad").alias("arr_delay"),
                     (F.col("dd") >= 15).alias("dep_del15"), (F.col("ad") >= 15).alias("arr_del15"))


def airports_df(spark):
    return spark.createDataFrame([(1, "ATL", "Georgia"), (2, "LAX", "California"),
                                  (3, "SFO", "California")],
                                 "airport_id int, airport_code string, state_name string")


def test_on_time_semantics(spark):
    rows = [("2025-01-01", "DL", 1, 2, False, False, 0, -6),     # early: on time, -6 averaged
            ("2025-01-01", "DL", 1, 2, False, False, 0, 14),     # 14 late: on time
            ("2025-01-01", "DL", 1, 2, False, False, 20, 15),    # 15 late: delayed
            ("2025-01-01", "DL", 1, 2, True, False, None, None),  # cancelled
            ("2025-01-01", "DL", 1, 2, False, True, 3, None),    # diverted
            ("2025-01-01", "DL", 1, 2, False, False, 1, None)]   # completed, unknown arrival: on time
    r = R.cards(flights_df(spark, rows), airports_df(spark), R.NO_FILTER,
                ["total_flights", "on_time_flights", "on_time_rate", "cancellation_rate",
                 "diversion_rate", "dep_delay_rate", "arr_delay_rate", "avg_arr_delay"]).first()
    assert r.total_flights == 6 and r.on_time_flights == 3
    assert abs(r.on_time_rate - 0.5) < 1e-12 and abs(r.dep_delay_rate - 1 / 6) < 1e-12
    assert abs(r.avg_arr_delay - (-6 + 14 + 15) / 3) < 1e-12


def test_rates_null_on_empty_selection(spark):
    rows = [("2025-01-01", "DL", 1, 2, False, False, 0, 0)]
    ctx = R.FilterContext(months=(2,))
    r = R.cards(flights_df(spark, rows), airports_df(spark), ctx, ["total_flights", "on_time_rate"]).first()
    assert r.total_flights == 0 and r.on_time_rate is None


def test_slicers_and_absent_airline(spark):
    rows = [("2025-07-01", "DL", 1, 2, False, False, 0, 0),
            ("2025-07-01", "AA", 2, 3, False, False, 0, 0),
            ("2025-08-01", "UA", 1, 3, False, False, 0, 0)]
    ctx = R.FilterContext(months=(7,), origin_states=("Georgia", "California"),
                          dest_states=("California",))
    got = {r.airline for r in R.by_airline(flights_df(spark, rows), airports_df(spark), ctx).collect()}
    assert got == {"DL", "AA"}
    assert ctx.is_filtered and not R.NO_FILTER.is_filtered


def test_highlight_max_branch_wins_on_ties(spark):
    df = spark.createDataFrame([("A", 0.5), ("B", 0.5)], "airline string, on_time_rate double")
    assert {r[2] for r in R.highlight(df, "on_time_rate").collect()} == {"BEST"}
    df2 = spark.createDataFrame([("A", 0.1), ("B", 0.3), ("C", 0.2)],
                                "airline string, cancellation_rate double")
    got = {r[0]: r[2] for r in R.highlight(df2, "cancellation_rate").collect()}
    assert got == {"A": "BEST", "B": "WORST", "C": None}


def test_topn_ties_and_busiest_routes(spark):
    rows = []
    for i in range(12):                       # 12 tiny routes at 100 %
        rows.append(("2025-01-01", "DL", 1, 2 + (i % 2), False, False, 0, 0))
    df = spark.createDataFrame([(f"R{i}", 1.0, 1) for i in range(12)] + [("BIG", 0.8, 500)],
                               "route string, on_time_rate double, total_flights long")
    ties = R.top_n_with_ties(df, 10, [F.desc("on_time_rate")])
    assert ties.count() == 12                 # more than N when the boundary ties
    exact = R.top_n(df, 10, [F.desc("on_time_rate"), F.desc("total_flights"), F.asc("route")])
    assert exact.count() == 10
    busiest = R.top_n(df, 1, [F.desc("total_flights"), F.asc("route")]).first()
    assert busiest.route == "BIG"


def test_monthly_keeps_years_apart(spark):
    rows = [("2024-07-01", "DL", 1, 2, False, False, 0, 0), ("2025-07-01", "DL", 1, 2, False, False, 0, 0)]
    got = sorted((r.year_month, r.month_name) for r in R.monthly(
        flights_df(spark, rows), airports_df(spark), R.NO_FILTER, ["total_flights"]).collect())
    assert got == [(202407, "July"), (202507, "July")]


def test_benchmark_hidden_under_slicers(spark):
    cur = spark.createDataFrame([(0.8,)], "on_time_rate double")
    r = R.benchmark_delta(cur, R.NO_FILTER, 0.75).first()
    assert abs(r.delta_pp - 5.0) < 1e-9 and r.trend == "UP"
    r2 = R.benchmark_delta(cur, R.FilterContext(airlines=("DL",)), 0.75).first()
    assert r2.delta_pp is None and r2.trend is None


def test_measure_registry_parts(spark):
    assert M.needed_parts(["on_time_rate", "avg_arr_delay"]) == [
        "on_time_flights", "total_flights", "arr_delay_sum", "arr_delay_n"]


def test_highlight_uses_scalar_subqueries_not_a_global_window(spark):
    from flightdeck.operators import report as R
    df = spark.createDataFrame([("a", 0.5), ("b", 0.9), ("c", 0.1), ("d", 0.9)],
                               "airline string, on_time_rate double")
    out = R.share_of_max(R.highlight(df, "on_time_rate", higher_is_better=True), "on_time_rate")
    got = {r.airline: (r.on_time_rate_highlight, round(r.volume_share, 6)) for r in out.collect()}
    assert got == {"a": (None, 0.555556), "b": ("BEST", 1.0), "c": ("WORST", 0.111111),
                   "d": ("BEST", 1.0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Subquery" in plan
