"""The report's cube on the star, table layout, sized writes, rank without a global window."""

import datetime
import glob

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMOKE, month_rows, raw_row
from flightdeck.operators import clean as CL
from flightdeck.operators import report as R
from flightdeck.operators.cube import LAYOUT, Star, flight_cube
from flightdeck.plans.pipeline import binding_star, build_warehouse
from flightdeck.session import scratch_path
from flightdeck.sinks import tables as T
from flightdeck.sources.testdata import airports


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


VISUALS = ["kpi_on_time_rate", "overview_cards", "slicer_filtered_kpis", "monthly_on_time", "airline_matrix",
           "top10_origin_volume", "route_kpis", "route_otr_min_volume", "benchmark_trend"]


@pytest.mark.parametrize("name", VISUALS)
def test_visuals_read_the_cube_alone(spark, name):
    text = plan(E.queries()[name](spark, SMOKE))
    assert "/flights-" not in text and "/fact-" not in text and "/staging-" not in text


def test_month_slicer_prunes_the_cube(spark):
    # the cube's folders are chosen by the months left in the calendar
    text = plan(E.queries()["slicer_filtered_kpis"](spark, SMOKE))
    assert "dynamicpruning" in text
    star = binding_star(spark, SMOKE)
    sliced = R.kpis(star, airports(spark, SMOKE), R.FilterContext(months=(7,)), [], ["total_flights"])
    want = star.cube.where("Month = 7").agg(F.sum("total_flights")).first()[0]
    assert sliced.first()["total_flights"] == want


def test_month_slice_prunes_staging(spark):
    text = E.queries()["month_slice"](spark, SMOKE)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in text and "(YEAR" in text.split("PartitionFilters: [")[1][:200]


def small_star(spark, raw_df, rows):
    wh = build_warehouse(CL.clean(raw_df(rows)))
    return Star(T.store(flight_cube(wh.fact), "t-cube", LAYOUT), wh.dates, wh.airlines, wh.airports)


def test_cube_equals_flights_and_empty_selections(spark, raw_df):
    rows = month_rows(per_month=3) + [raw_row(CANCELLED="1.0", ARR_DEL15=None, ARR_DELAY=None, DEP_DELAY=None,
                                              DEP_DEL15=None, OP_CARRIER_FL_NUM="999")]
    star = small_star(spark, raw_df, rows)
    nowhere = spark.createDataFrame([(10397, "ATL", "Atlanta", "Georgia"), (12892, "LAX", "Los Angeles", "California")],
                                    "airport_id int, airport_code string, city_name string, state_name string")
    card = R.cards(star, nowhere, R.NO_FILTER, ["total_flights", "cancelled_flights", "on_time_rate", "avg_arr_delay"]).first()
    assert (card["total_flights"], card["cancelled_flights"]) == (37, 1)
    assert card["on_time_rate"] == 36 / 37 and card["avg_arr_delay"] == -4.0
    for ctx in (R.FilterContext(origin_states=("Nowhere",)), R.FilterContext(airlines=("ZZ",)), R.FilterContext(months=(13,))):
        none = R.cards(star, nowhere, ctx, ["total_flights", "cancelled_flights", "on_time_rate", "avg_arr_delay"]).first()
        assert tuple(none) == (0, 0, None, None)
    some = R.cards(star, nowhere, R.FilterContext(months=(1, 2), origin_states=("Georgia",), airlines=("DL",)), ["total_flights"])
    assert some.first()["total_flights"] == 7
    routes = R.by_route(star, nowhere, R.NO_FILTER, ["total_flights"]).collect()
    assert [(r["origin_code"], r["dest_code"], r["total_flights"]) for r in routes] == [("ATL", "LAX", 37)]


def test_rank_equals_the_window(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 50 != 0, (F.col("id") * 7919 % 37).cast("double")).alias("rate"))
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_last("rate"))))
    got = R.ranked(df, "rate", "r").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    text = plan(R.ranked(df, "rate", "r"))
    # the only rows that meet in one task are the totals, one a range
    for window in text.split("Window [")[1:]:
        assert "_range" in window[:400]


def test_months_are_written_at_file_size(spark):
    days = [(datetime.date(2025, 1, 1), i, f"{i * 7919 % 104729:08d}" * 8) for i in range(20_000)]
    days += [(datetime.date(2025, 2, 1), 1, "x")]
    df = (spark.createDataFrame(days, "d date, n int, v string").repartition(16)
          .withColumn("Year", F.year("d")).withColumn("Month", F.month("d")))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = scratch_path(spark, "t-sized")
        T.write_table(df, path, ("Year", "Month"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot, tiny = (len(glob.glob(f"{path}/Year=2025/Month={m}/*.parquet")) for m in (1, 2))
    # 1.5 MB in 256 kB tasks, and a single row: 16 tasks would have made 16 and 1
    assert 2 <= hot <= 12 and tiny == 1
    assert T.read_table(spark, path, df.schema).count() == 20_001


def test_forgotten_tables_are_deleted(spark):
    import os
    df = T.store(spark.range(5), "t-forget")
    path = T._WRITTEN[spark.sparkContext.applicationId][-1]
    assert df.count() == 5 and os.path.isdir(path)
    kept = T._WRITTEN.pop(spark.sparkContext.applicationId), dict(T._STORED)
    T._WRITTEN[spark.sparkContext.applicationId] = [path]
    T.forget(spark)
    assert not os.path.exists(path) and not T._STORED
    T._WRITTEN[spark.sparkContext.applicationId] = kept[0][:-1]
    T._STORED.update(kept[1])
