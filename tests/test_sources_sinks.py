"""File sources and sinks: raw scan with header checks, manifests, processed
round trip, lookup files, partition refresh, publish."""

import pytest
from pyspark.sql import functions as F

from conftest import month_rows
from flightdeck.operators import clean as CL
from flightdeck.operators import quality as Q
from flightdeck.schemas import STAGING_NAMES
from flightdeck.session import scratch_path
from flightdeck.sinks import files as SK
from flightdeck.sources import files as SR


def test_raw_monthly_round_trip_and_manifest(spark, raw_df):
    raw = raw_df(month_rows(months=range(1, 12)) + month_rows(year=2024, months=[5]))
    path = scratch_path(spark, "t-raw")
    SK.write_monthly_csv(raw, path)
    back = SR.read_raw(spark, path)
    assert back.count() == 24 and back.select(*STAGING_NAMES).subtract(raw).count() == 0
    assert back.filter(F.col("ORIGIN_CITY_NAME") == "Atlanta, GA").count() == 24   # quoted comma
    man = {(r.file_year, r.file_month): r.status for r in SR.file_manifest(spark, path, 2025, 2025).collect()}
    assert man[(2025, 12)] == "missing" and man[(2024, 5)] == "extra" and man[(2025, 1)] == "present"


def test_reordered_header_is_detected(spark, raw_df):
    raw = raw_df(month_rows(months=[1]))
    cols = list(STAGING_NAMES)
    cols[0], cols[1] = cols[1], cols[0]
    path = scratch_path(spark, "t-hdr")
    SK.write_monthly_csv(raw.select(*cols), path)
    rep = SR.header_report(spark, path).collect()
    assert rep and all(r.same_order is False and r.missing_columns == 0 for r in rep)
    with pytest.raises(Exception):
        SR.read_raw(spark, path).collect()


def test_processed_round_trip(spark, raw_df):
    stg = CL.clean(raw_df(month_rows()))
    path = scratch_path(spark, "t-proc")
    SK.write_processed_monthly(stg, path)
    back = SR.read_processed(spark, path)
    assert back.schema.simpleString() == stg.schema.simpleString().replace(":", ":")
    assert back.subtract(stg).count() == 0 and back.count() == stg.count()
    text = SR.read_text(spark, path).first()
    assert text["FL_DATE"] == "2025-01-01" or text["FL_DATE"].startswith("2025-")
    assert text["CANCELLATION_CODE"] == ""


def test_mapping_with_bom_and_crlf(spark):
    path = scratch_path(spark, "t-map")
    lines = spark.createDataFrame([(0, "﻿Airline_Code,Airline_Name"), (1, "DL,Delta Air Lines"),
                                   (2, "AA,American Airlines")], "o int, value string")
    lines.coalesce(1).sortWithinPartitions("o").select("value").write.option("lineSep", "\r\n").text(path)
    got = SR.read_mapping(spark, path)
    assert got.columns == ["Airline_Code", "Airline_Name"]
    assert sorted(map(tuple, got.collect())) == [("AA", "American Airlines"), ("DL", "Delta Air Lines")]


def test_refresh_replaces_only_touched_months(spark, raw_df):
    stg = CL.clean(raw_df(month_rows(months=[1, 2, 3])))
    path = scratch_path(spark, "t-refresh")
    SK.refresh_months(stg.withColumn("v", F.lit(1)), path)
    SK.refresh_months(stg.filter(F.month("FL_DATE") == 2).withColumn("v", F.lit(2)), path)
    got = sorted((r.file_month, r.v) for r in spark.read.parquet(path).select("file_month", "v").distinct().collect())
    assert got == [(1, 1), (2, 2), (3, 1)]


def test_publish_is_all_or_nothing(spark, raw_df):
    stg = CL.clean(raw_df(month_rows()))
    root = scratch_path(spark, "t-pub")
    SK.publish(stg, root, "run1", gate=lambda df: Q.enforce(
        Q.check_frame(df.agg(F.count(F.lit(1)).alias("n")), "rows", None, F.lit("x"), "n", 24)))
    bad = stg.limit(3)
    with pytest.raises(Q.GateError):
        SK.publish(bad, root, "run2", gate=lambda df: Q.enforce(
            Q.check_frame(df.agg(F.count(F.lit(1)).alias("n")), "rows", None, F.lit("x"), "n", 24)))
    assert SK.read_published(spark, root).count() == 24


def test_union_of_monthly_frames(spark, raw_df):
    from functools import reduce
    months = [CL.clean(raw_df(month_rows(months=[m]))) for m in range(1, 13)]
    year = reduce(lambda a, b: a.unionByName(b), months)
    assert year.count() == 24


def test_stream_loads_new_months_once(spark, raw_df):
    from flightdeck.streaming.monthly_files import load_new_months
    raw_dir = scratch_path(spark, "t-stream-raw")
    SK.write_monthly_csv(raw_df(month_rows(months=[1, 2])), raw_dir)
    out, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ckpt")
    load_new_months(spark, raw_dir, out, ckpt)
    assert spark.read.parquet(out).count() == 4
    load_new_months(spark, raw_dir, out, ckpt)            # nothing new: nothing duplicated
    assert spark.read.parquet(out).count() == 4
    more = scratch_path(spark, "t-stream-raw")             # a later delivery of month 3
    SK.write_monthly_csv(raw_df(month_rows(months=[3])), more)
    load_new_months(spark, more, out, scratch_path(spark, "t-stream-ckpt"))
    got = sorted((r.file_month, r.n) for r in spark.read.parquet(out).groupBy("file_month")
                 .agg(F.count(F.lit(1)).alias("n")).collect())
    assert got == [(1, 2), (2, 2), (3, 2)]
