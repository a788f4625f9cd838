"""Scalar functions (I1-I14) including the conversion traps."""

from pyspark.sql import functions as F

from flightdeck import functions as FN


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_hhmm_examples_and_traps(spark):
    vals = ["0", "1", "530", "1435", "2359", "2400", None, "2401", "1260", "-5", "2500",
            "530.7", "abc", "530.0"]
    out = [r[0] for r in one_col(spark, vals).select(FN.hhmm_to_time("v")).collect()]
    assert out == ["00:00", "00:01", "05:30", "14:35", "23:59", "00:00", None, "INVALID",
                   "INVALID", "INVALID", "INVALID", "05:30", "INVALID", "05:30"]


def test_hhmm_numeric_input(spark):
    df = spark.createDataFrame([(530.7,), (2400.0,), (None,)], "v double")
    assert [r[0] for r in df.select(FN.hhmm_to_time("v")).collect()] == ["05:30", "00:00", None]


def test_parse_flight_date(spark):
    vals = ["1/1/2025 12:00:00 AM", "12/31/2025 12:00:00 AM", "13/1/2025 12:00:00 AM", None,
            "7/4/2025 3:05:09 pm"]
    out = [r[0] for r in one_col(spark, vals).select(FN.parse_flight_date("v")).collect()]
    assert [str(x) if x else None for x in out] == ["2025-01-01", "2025-12-31", None, None,
                                                    "2025-07-04"]


def test_strict_integer(spark):
    df = one_col(spark, ["7", "7.0", None, "x", "7.5", " 8 "])
    rows = df.select(FN.strict_integer("v"), FN.is_non_numeric("v"), FN.is_fractional("v")).collect()
    assert [tuple(r) for r in rows] == [(7, False, False), (7, False, False), (None, False, False),
                                        (None, True, False), (None, False, True), (8, False, False)]


def test_missing_tokens(spark):
    out = [r[0] for r in one_col(spark, ["NA", "null", "NaN", "N123", ""]).select(
        FN.nullif_tokens("v")).collect()]
    assert out == [None, None, None, "N123", None]


def test_calendar_functions(spark):
    df = spark.createDataFrame([("2025-01-05",), ("2025-01-06",)], "d string").select(
        F.to_date("d").alias("d"))
    r = df.select(FN.date_key("d"), FN.year_month_key("d"), FN.iso_weekday("d"),
                  FN.is_weekend("d"), FN.date_names("d")["MonthName"],
                  FN.date_names("d")["DayName"], FN.date_names("d")["QuarterName"],
                  FN.iso_date_text("d"), FN.zero_pad(F.month("d"))).collect()
    assert tuple(r[0]) == (20250105, 202501, 7, True, "January", "Sunday", "Q1", "2025-01-05", "01")
    assert tuple(r[1])[2:4] == (1, False)


def test_safe_divide_bit_cast_route_label(spark):
    df = spark.createDataFrame([(1, 0, 1, "LAX", None), (3, 4, 0, "JFK", "LAX"),
                                (None, 2, None, None, "SFO")], "a int, b int, f int, o string, d string")
    rows = df.select(FN.safe_divide("a", "b"), FN.bit_cast("f"), FN.route_label("o", "d")).collect()
    assert tuple(rows[0]) == (None, True, "LAX → ")
    assert tuple(rows[1]) == (0.75, False, "JFK → LAX")
    assert tuple(rows[2]) == (None, None, " → SFO")


def test_no_python_udf_in_expressions(spark):
    df = one_col(spark, ["530"]).select(FN.hhmm_to_time("v"), FN.parse_flight_date("v"),
                                        FN.strict_integer("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_ordered_listagg_distinct_and_nulls(spark):
    from flightdeck.operators.profile import ordered_listagg
    df = spark.createDataFrame(
        [("DL", "LAX"), ("DL", "ATL"), ("DL", "LAX"), ("DL", None), ("UA", "SFO"), ("AA", None)],
        "airline string, origin string")
    got = {r.airline: r.value_list for r in ordered_listagg(df, ["airline"], "origin", "origin").collect()}
    # one entry per distinct value, ordered; NULL values skipped (an all-NULL group has no row)
    assert got == {"DL": "ATL,LAX", "UA": "SFO"}
    dup = {r.airline: r.value_list
           for r in ordered_listagg(df, ["airline"], "origin", "origin", distinct=False).collect()}
    assert dup["DL"] == "ATL,LAX,LAX"
