"""What keeps a load within time and disk: views, lazy numbering, monthly files undealt."""

from __future__ import annotations

import glob
import gzip

import __spark_entry__ as E
import pytest
from conftest import SMOKE, month_rows, raw_row
from pyspark.sql import Window
from pyspark.sql import functions as F

from flightdeck.operators.keys import numbered_by_group
from flightdeck.plans.pipeline import binding_fact, binding_staging
from flightdeck.schemas import STAGING_NAMES
from flightdeck.session import compile_in_parts, scratch_path
from flightdeck.sinks import files as SK
from flightdeck.sinks import tables as T
from flightdeck.sources import files as SR
from flightdeck.sources.testdata import raw_flights


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_staging_is_a_view_over_narrow_rows(spark):
    read = binding_staging(spark, SMOKE).select("DEST_AIRPORT_ID")._jdf.queryExecution().executedPlan().toString()
    assert "c_nationkey" in read and "l_partkey" not in read
    assert not [k for _, k in T._STORED if k.startswith(("raw:", "staging:", "fact:"))]


def test_fact_is_numbered_only_where_its_number_is_read(spark):
    fact = binding_fact(spark, SMOKE)
    assert "Window" not in _plan(fact.groupBy("DateKey").count())
    assert "Window" in _plan(fact.select("FlightKey"))


@pytest.mark.parametrize("limit", [1_000_000, 150, 10])
def test_days_are_numbered_like_a_global_row_number(spark, limit):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.lit(20250101) + F.col("id") % 5).cast("int").alias("day"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 4).cast("int").alias("airline"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 37) % 100).cast("int").alias("flight"), F.col("id").alias("rest"))
    order = ["day", "airline", "flight", "rest"]
    want = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = numbered_by_group(df, order, "k", limit)
    assert sorted(map(repr, got.select(*order, "k").collect())) == sorted(map(repr, want.collect()))


def test_large_methods_are_left_to_operators(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    local = spark.sparkContext.getConf().get("spark.driver.extraJavaOptions", "")
    compile_in_parts(spark)
    if "-DontCompileHugeMethods" not in local:
        assert spark.conf.get(key) == "8000"


def test_months_laid_out_already_are_not_dealt_again(spark):
    path = scratch_path(spark, "t-clustered")
    raw = raw_flights(spark, SMOKE)
    SK.write_monthly_csv(raw, path, clustered=True, compression="gzip")
    assert glob.glob(f"{path}/file_year=*/file_month=*/*.csv.gz") and not glob.glob(f"{path}/**/*.csv", recursive=True)
    back = SR.read_raw(spark, path).select(*STAGING_NAMES)
    assert back.count() == raw.count() and back.exceptAll(raw).isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    report = SR.file_report(spark, path)
    assert report.where("NOT terminated OR NOT same_order OR odd_lines > 0 OR file_year IS NULL").isEmpty()
    assert report.agg(F.sum(F.col("lines") - 1)).first()[0] == raw.count()


@pytest.mark.parametrize("end, whole", [("\n", True), ("", False), (",", False), ("\n,", False)])
def test_last_line_of_a_compressed_file(spark, raw_df, tmp_path, end, whole):
    text = ",".join(STAGING_NAMES) + "\n" + ",".join("" if v is None else f'"{v}"' for v in raw_row())
    with gzip.open(tmp_path / "2025_01.csv.gz", "wt") as f:
        f.write(text + end)
    row = SR.file_report(spark, str(tmp_path)).first()
    assert row["terminated"] is whole and row["file_month"] == 1


def test_refresh_keeps_other_months_when_rows_are_not_dealt(spark, raw_df):
    path = scratch_path(spark, "t-refresh")
    from flightdeck.operators import clean as CL
    SK.refresh_months(CL.clean(raw_df(month_rows(months=[1, 2, 3]))), path, clustered=True)
    SK.refresh_months(CL.clean(raw_df(month_rows(months=[2], per_month=1))), path, clustered=True)
    got = {r["file_month"]: r["count"] for r in spark.read.parquet(path).groupBy("file_month").count().collect()}
    assert got == {1: 2, 2: 1, 3: 2}


def test_catalogue_queries_still_agree_without_stored_rows(spark):
    got = E.queries()["head_tail"](spark, SMOKE).collect()
    n = E.queries()["row_count"](spark, SMOKE).first()[0]
    assert [r["FlightKey"] for r in got] == [1, 2, 3, 4, 5, n, n - 1, n - 2, n - 3, n - 4]
