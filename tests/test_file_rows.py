"""File reports, parsed rows and samples at size: nothing wide is sorted, dealt or cut small."""

from __future__ import annotations

import glob
import gzip
import os

import __spark_entry__ as E
import pytest
from conftest import SMOKE, month_rows, raw_row
from pyspark.sql import functions as F

from flightdeck.operators import profile as P
from flightdeck.plans import q_sources as QS
from flightdeck.schemas import STAGING_NAMES
from flightdeck.session import scratch_path
from flightdeck.sinks import files as SK
from flightdeck.sources import files as SR
from flightdeck.sources.testdata import raw_flights

HEADER = ",".join(STAGING_NAMES)
EMPTY_LAST = ",".join("" if v is None else f'"{v}"' for v in raw_row())
FILLED_LAST = EMPTY_LAST + "7"


def _plan(df, kind="executedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_lines_are_combined_without_a_sort(spark, raw_df):
    path = scratch_path(spark, "t-lines")
    SK.write_monthly_csv(raw_df(month_rows()), path, compression="gzip")
    for report in (SR.header_report(spark, path), SR.file_report(spark, path)):
        assert "SortAggregate" not in _plan(report) and "HashAggregate" in _plan(report)


# every ending under both ways to count the bytes of a compressed file
@pytest.mark.parametrize("most, cut", [(64 << 20, ",\n"), (0, ",")])
def test_compressed_bytes_are_counted_by_lines_or_by_commas(spark, tmp_path, monkeypatch, most, cut):
    ends = {"01": (EMPTY_LAST + "\n", True), "02": (EMPTY_LAST, False), "03": (FILLED_LAST + "\n", True),
            "04": (FILLED_LAST, False), "05": (EMPTY_LAST + "\n\n", True), "06": (FILLED_LAST + "\n,", False)}
    for month, (last, _) in ends.items():
        with gzip.open(tmp_path / f"2025_{month}.csv.gz", "wt") as f:
            f.write("\n".join([HEADER, EMPTY_LAST, FILLED_LAST, last]))
    cuts, sizes = [], SR._unpacked_sizes
    monkeypatch.setattr(SR, "MOST_BETWEEN", most)
    monkeypatch.setattr(SR, "_unpacked_sizes", lambda s, p, c: cuts.append(c) or sizes(s, p, c))
    got = {r["file_name"][5:7]: r["terminated"] for r in SR.file_report(spark, str(tmp_path)).collect()}
    assert got == {m: whole for m, (_, whole) in ends.items()} and cuts == [cut]


def test_rows_are_parsed_whole_though_no_column_is_read(spark, tmp_path):
    (tmp_path / "2025_01.csv").write_text("\n".join([HEADER, EMPTY_LAST, "2025,1,1", ""]))
    lenient = SR.parsed_rows(spark, str(tmp_path), mode="DROPMALFORMED")
    assert [r["rows"] for r in lenient.collect()] == [1] and "ReadSchema: struct<>" in _plan(lenient)
    with pytest.raises(Exception, match="(?i)malformed"):
        SR.parsed_rows(spark, str(tmp_path)).collect()


def test_raw_files_are_written_at_the_fast_level(spark):
    paths = [scratch_path(spark, "t-level") for _ in range(2)]
    for path, level in zip(paths, (None, "BEST_SPEED")):
        SK.write_monthly_csv(raw_flights(spark, SMOKE), path, clustered=True, compression="gzip", level=level)
    slow, fast = (sum(map(os.path.getsize, glob.glob(f"{p}/*/*/*.csv.gz"))) for p in paths)
    assert slow < fast < 2 * slow
    assert SR.read_raw(spark, paths[1]).select(*STAGING_NAMES).exceptAll(raw_flights(spark, SMOKE)).isEmpty()


def test_sampled_rows_are_looked_up_without_dealing_all(spark):
    rows = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"))
    few = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 99), (None, 1)], "k bigint, v bigint").unionByName(rows.limit(3))
    alike = QS.rows_like(QS.rows_like(rows, few, ["k"]), few, ["k", "v"])
    assert alike.count() < 40 and "Exchange hashpartitioning" not in _plan(alike)
    want, got = (sorted(map(repr, few.exceptAll(r).collect())) for r in (rows, alike))
    assert want == got and want


def test_sample_export_keeps_staging_out_of_the_shuffle(spark):
    out = E.queries()["rt_sample_export"](spark, SMOKE)
    assert _plan(out, "optimizedPlan").count("LeftSemi") == 2
    assert out.where("not_in_staging > 0").isEmpty()


def test_draw_keeps_rows_at_or_below_the_limit_of_their_stratum(spark):
    rows = spark.createDataFrame([(0, 10, "a"), (0, 11, "b"), (None, 1, "c"), (None, 2, "d"), (7, 0, "e")],
                                 "s int, _place bigint, w string")
    limits = spark.createDataFrame([(0, 10), (None, 1)], "s int, _last bigint")
    kept = P._below(rows, limits, ["s"])
    assert kept.columns == rows.columns and "LeftSemi" in _plan(kept)
    assert sorted(r["w"] for r in kept.collect()) == ["a", "c"]
