"""Exact medians by selection and samples by threshold, against plain windows."""

import statistics

from pyspark.sql import Window
from pyspark.sql import functions as F

from flightdeck.operators import profile as P


def test_medians_of_even_odd_hot_and_empty_columns(spark):
    rows = [(i, 7 if i % 3 else i, None, -i * 0.5 if i < 10 else None) for i in range(1, 401)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d double")
    got = {r["column_name"]: (r["mean"], r["median"]) for r in P.duration_profile(df, ["a", "b", "c", "d"], 16).collect()}
    for c in "abd":
        i = "abcd".index(c)
        values = [r[i] for r in rows if r[i] is not None]
        assert abs(got[c][0] - sum(values) / len(values)) <= 0.005 + 1e-9 and got[c][1] == statistics.median(values)
    assert got["c"] == (None, None)
    none = P.duration_profile(df.limit(0), ["a", "c"]).collect()
    assert sorted(tuple(r) for r in none) == [("a", None, None), ("c", None, None)]


def test_as_many_values_as_rows_lie_in_many_ranges(spark):
    df = spark.range(0, 40_000).select((F.col("id") * 7919 % 40_009).alias("v"))
    sizes = P.value_ranges(df, ["v"], 16).groupBy("_range").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 8_000
    values = sorted(i * 7919 % 40_009 for i in range(40_000))
    assert P.duration_profile(df, ["v"], 16).collect()[0]["median"] == (values[19_999] + values[20_000]) / 2


def plain_sample(df, strata, n, seed, key):
    w = Window.partitionBy(*strata).orderBy(F.xxhash64(*key, F.lit(seed)), *key)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def test_sample_by_threshold_takes_the_same_rows(spark):
    # one stratum holds most rows, one is NULL, one has fewer than n
    df = spark.range(0, 30_000).select(
        "id", F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 20_007, "tiny").when(F.col("id") % 2 == 0, "even")
        .alias("s"))
    want = sorted(map(tuple, plain_sample(df, ["s"], 100, 3, ["id"]).collect()), key=str)
    for slack in (6.0, -9.9):  # the second starts far too low and is filled up by rereading
        got = sorted(map(tuple, P.stratified_sample(df, ["s"], 100, 3, ["id"], slack).collect()), key=str)
        assert got == want
    assert P.stratified_sample(df.limit(0), ["s"], 100, 3, ["id"]).count() == 0


def test_candidates_are_little_more_than_the_sample(spark):
    df = spark.range(0, 200_000).select("id", (F.col("id") % 3).alias("s")).repartition(40)
    sizes = P.sample_candidates(df, ["s"], 100, F.xxhash64("id")).groupBy("s").count().collect()
    assert len(sizes) == 3 and all(100 <= r["count"] <= 100 + 2 * (6 * 10 + 10) for r in sizes)
