"""Calendar, dedup / latest version, surrogate keys and upsert."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import month_rows, raw_row
from flightdeck.operators import clean as CL
from flightdeck.operators import dims as D
from flightdeck.operators import keys as K
from flightdeck.operators.keys import grouped_keys, sequential_keys


def test_spine_includes_gap_days(spark, raw_df):
    stg = CL.clean(raw_df([raw_row(FL_DATE="1/1/2025 12:00:00 AM"),
                           raw_row(FL_DATE="1/5/2025 12:00:00 AM")]))
    days = [str(r[0]) for r in D.date_spine(stg).orderBy("Date").collect()]
    assert days == ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04", "2025-01-05"]


def test_dim_date_columns(spark, raw_df):
    stg = CL.clean(raw_df([raw_row(FL_DATE="3/1/2025 12:00:00 AM")]))
    r = D.dim_date(D.date_spine(stg)).first().asDict()
    assert r["DateKey"] == 20250301 and r["QuarterName"] == "Q1" and r["MonthName"] == "March"
    assert r["DayOfWeek"] == 6 and r["DayName"] == "Saturday" and r["IsWeekend"] is True
    assert r["YearMonth"] == 202503


def test_airline_smallest_code_pair_wins(spark, raw_df):
    stg = CL.clean(raw_df([raw_row(OP_UNIQUE_CARRIER="ZZ", OP_CARRIER="AA"),
                           raw_row(OP_UNIQUE_CARRIER="DL", OP_CARRIER="ZZ"),
                           raw_row(OP_UNIQUE_CARRIER="DL", OP_CARRIER="DL")]))
    r = D.airline_current(stg).collect()
    assert [(x.DOTAirlineID, x.UniqueCarrierCode, x.CarrierCode) for x in r] == [(19790, "DL", "DL")]


def test_airport_latest_sequence_wins_and_destination_only(spark, raw_df):
    stg = CL.clean(raw_df([
        raw_row(ORIGIN_AIRPORT_SEQ_ID="1039701", ORIGIN_CITY_NAME="Old Atlanta, GA"),
        raw_row(ORIGIN_AIRPORT_SEQ_ID="1039709", ORIGIN_CITY_NAME="Atlanta, GA"),
        raw_row(DEST_AIRPORT_ID="14747", DEST="SEA", DEST_AIRPORT_SEQ_ID="1474703",
                DEST_CITY_NAME="Seattle, WA")]))
    cur = {r.AirportID: r for r in D.airport_current(stg).collect()}
    assert cur[10397].AirportSeqID == 1039709 and cur[10397].CityName == "Atlanta, GA"
    assert cur[14747].AirportCode == "SEA"          # seen only as a destination


def test_airport_null_sequence_sorts_last(spark):
    from pyspark.sql import types as T
    from flightdeck.schemas import staging_schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in staging_schema().fields])
    base = {f.name: None for f in schema.fields}
    rows = []
    for seq, city in ((None, "Null City"), (5, "Five City")):
        r = dict(base, ORIGIN_AIRPORT_ID=1, ORIGIN_AIRPORT_SEQ_ID=seq, ORIGIN="AAA",
                 ORIGIN_CITY_NAME=city, ORIGIN_STATE_ABR="XX", ORIGIN_STATE_NM="X",
                 DEST_AIRPORT_ID=2, DEST_AIRPORT_SEQ_ID=7, DEST="BBB", DEST_CITY_NAME="B",
                 DEST_STATE_ABR="YY", DEST_STATE_NM="Y")
        rows.append(tuple(r[f.name] for f in schema.fields))
    stg = spark.createDataFrame(rows, schema)
    cur = {r.AirportID: r for r in D.airport_current(stg).collect()}
    assert cur[1].AirportSeqID == 5


def test_sequential_keys_equal_global_row_number_under_skew(spark):
    random.seed(7)
    # a third of the rows share one leading key value
    rows = [(1 if i % 3 == 0 else random.randint(2, 50), random.randint(0, 1000), i % 17)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = sequential_keys(df, ["a", "b"], "k").select("a", "b", "c", "k")
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b", "c")).cast("bigint"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the rows come numbered from the stored table, and no window runs over them
    assert "numbered-rows" in plan


def test_upsert_keeps_keys_adds_max_plus_one_never_deletes(spark):
    target = spark.createDataFrame([(1, 100, "AA", "AA"), (2, 200, "BB", "BB"), (3, 300, "CC", "CC")],
                                   "AirlineKey int, DOTAirlineID int, UniqueCarrierCode string, CarrierCode string")
    source = spark.createDataFrame([(200, "BX", "BB"), (100, "AA", "AA"), (400, "DD", "DD"),
                                    (350, "EE", "EE")],
                                   "DOTAirlineID int, UniqueCarrierCode string, CarrierCode string")
    attrs = ["UniqueCarrierCode", "CarrierCode"]
    out = D.upsert(target, source, ["DOTAirlineID"], attrs, "AirlineKey",
                   update_when=D.attrs_changed(attrs))
    got = {r.DOTAirlineID: (r.AirlineKey, r.UniqueCarrierCode, r._action) for r in out.collect()}
    assert got == {100: (1, "AA", "keep"), 200: (2, "BX", "update"), 300: (3, "CC", "keep"),
                   350: (4, "EE", "insert"), 400: (5, "DD", "insert")}


def test_upsert_smart_key_always_updates(spark):
    t = spark.createDataFrame([(20250101, "x")], "DateKey int, v string")
    s = spark.createDataFrame([(20250101, "y"), (20250102, "z")], "DateKey int, v string")
    got = sorted(map(tuple, D.upsert(t, s, ["DateKey"], ["v"]).collect()))
    assert got == [(20250101, "y", "update"), (20250102, "z", "insert")]


def test_dimension_keys_are_dense(spark, raw_df):
    stg = CL.clean(raw_df(month_rows() + [raw_row(OP_CARRIER_AIRLINE_ID="20000", OP_CARRIER="AA",
                                                  OP_UNIQUE_CARRIER="AA")]))
    keys = sorted((r.DOTAirlineID, r.AirlineKey) for r in D.dim_airline(stg).collect())
    assert keys == [(19790, 1), (20000, 2)]


def test_upsert_into_empty_target_numbers_from_one(spark):
    target = spark.createDataFrame(
        [], "AirlineKey int, DOTAirlineID int, UniqueCarrierCode string, CarrierCode string")
    source = spark.createDataFrame([(300, "CC", "CC"), (100, "AA", "AA")],
                                   "DOTAirlineID int, UniqueCarrierCode string, CarrierCode string")
    out = D.upsert(target, source, ["DOTAirlineID"], ["UniqueCarrierCode", "CarrierCode"], "AirlineKey")
    got = {r.DOTAirlineID: (r.AirlineKey, r._action) for r in out.collect()}
    assert got == {100: (1, "insert"), 300: (2, "insert")}
    assert dict(out.dtypes)["AirlineKey"] == "int"


@pytest.mark.parametrize("limit", [1_000_000, 40, 7])
def test_grouped_keys_equal_a_global_row_number(spark, limit):
    rng = random.Random(limit)
    # one day holds a third of all rows, one airline on it nearly all of those
    rows = [(20250101, 7, rng.choice([None, *range(500)]), i) for i in range(300)]
    rows += [(rng.choice([None, 20250101, 20250102, 20250105]), rng.choice([None, 1, 2, 7]),
              rng.choice([None, -3, 5, 10**6]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "day int, airline int, flight int, rest int").repartition(5)
    order = ["day", "airline", "flight", "rest"]
    want = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = grouped_keys(df, order, "k", limit)
    assert sorted(map(repr, got.select(*order, "k").collect())) == sorted(map(repr, want.collect()))


def test_large_groups_are_cut(spark):
    df = spark.range(1000).select(F.lit(1).alias("day"), F.lit(2).alias("airline"), F.col("id").cast("int").alias("flight"))
    cut = K.group_pieces(df, ["day", "airline"], "flight", 100).groupBy("_piece").count().collect()
    assert len(cut) == 10 and max(r["count"] for r in cut) <= 100


def test_keys_run_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(200).selectExpr("cast(id % 5 as int) a", "cast(id % 3 as int) b", "cast(id as int) c")
    for make in (grouped_keys, sequential_keys):
        seen.value = 0
        make(df.mapInArrow(counted, df.schema), ["a", "b", "c"], "k").write.format("noop").mode("overwrite").save()
        assert seen.value == 200
