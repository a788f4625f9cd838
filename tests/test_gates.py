"""Fused gates equal the single ones; files are reconciled one by one; writes are observed."""

import pytest
from pyspark.sql import functions as F

from conftest import month_rows, raw_row
from flightdeck.operators import clean as CL
from flightdeck.operators import fact as FT
from flightdeck.operators import gates as G
from flightdeck.operators import quality as Q
from flightdeck.plans import pipeline as P
from flightdeck.plans.q_fact import monthly_reconciliation
from flightdeck.sinks import tables as T
from flightdeck.sources.files import file_report
from test_load_pipeline import PERIOD, every_day, load, write_month, year  # noqa: F401


def rows(checks):
    return sorted(map(repr, checks.collect()))


def spoilt(raw_df):
    """Two months missing, a row under a wrong month, one without a date."""
    return CL.clean(raw_df(month_rows(months=range(1, 11)) + [raw_row(MONTH="3", OP_CARRIER_FL_NUM="7"),
                                                              raw_row(FL_DATE="no date", OP_CARRIER_FL_NUM="8")]))


@pytest.mark.parametrize("bad", [False, True])
def test_staging_gates_equal_the_single_gates(spark, raw_df, bad):
    staging = T.store(spoilt(raw_df) if bad else CL.clean(raw_df(month_rows())), "t-staging")
    fused, _ = G.staging_gates(staging, PERIOD)
    single = Q.union_checks(Q.year_month_coverage(staging, PERIOD), Q.split_complete(staging), Q.month_nonempty(staging, PERIOD),
                            Q.month_purity(staging), Q.all_months(staging, PERIOD))
    assert rows(fused) == rows(single)
    assert (fused.where("NOT passed").count() > 0) == bad


@pytest.mark.parametrize("bad", [False, True])
def test_fact_gates_equal_the_single_gates_and_read_once(spark, raw_df, bad):
    staging = T.store(CL.clean(raw_df(month_rows() + month_rows(year=2026, months=[1]))), "t-staging")
    wh = P.build_warehouse(staging)
    fact, airports, period = wh.fact, wh.airports, Q.Period(2025, 2026)
    if bad:
        fact = fact.where("FlightKey % 5 <> 0").withColumn("DistanceMiles", F.when(F.col("FlightKey") % 3 > 0, F.col("DistanceMiles")))
        fact = fact.withColumn("DateKey", F.when(F.col("FlightKey") != 7, F.col("DateKey")).otherwise(F.lit(19990101)))
        airports, period = airports.where("AirportKey <> 1"), PERIOD
    fact = T.store(fact, "t-gated-fact")
    _, months = G.staging_gates(staging, period)
    fused = G.fact_gates(fact, wh.dates, wh.airlines, airports, months, period)
    single = Q.union_checks(Q.row_reconciliation(staging, fact, code=50030), Q.referential(fact, wh.dates, wh.airlines, airports),
                            Q.required_nulls(fact), Q.monthly_recon(monthly_reconciliation(staging, fact, wh.dates)),
                            Q.fact_date_range(fact, wh.dates, period))
    assert rows(fused) == rows(single)
    assert {r["code"] for r in fused.where("NOT passed").collect()} == ({50030, 50036, 50037, 50038, 50039} if bad else set())
    counted = G.fact_counters(fact, wh.airlines, airports)
    counted.need(F.count(F.lit(1)))
    plan = counted.plan()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlightNumber") and plan.count("Relation [FlightKey") == 1
    assert "t-gated-fact" not in fused._jdf.queryExecution().toString()


def test_a_counter_is_counted_once(spark):
    counters = G.Counters(spark.range(5), {"g": F.col("id") % 2})
    assert counters.need(F.count(F.lit(1))) == counters.need(F.count(F.lit(1))) != counters.need(F.count("id"))
    assert len(counters.plan().columns) == 3


def test_rows_lost_while_writing_fail_by_the_observed_counts(spark, year, tmp_path, monkeypatch):  # noqa: F811
    real = FT.fact_flights
    monkeypatch.setattr(P.FT, "fact_flights", lambda *a: real(*a).where("FlightKey <> 5"))
    monkeypatch.setattr(Q, "row_reconciliation", None)  # the gate must not need another scan
    with pytest.raises(Q.GateError) as e:
        load(spark, year, tmp_path / "w", "run")
    assert (e.value.code, e.value.observed, e.value.expected) == (50022, 364, 365)


def cut(folder, month, keep):
    path = folder / f"2025_{month:02d}.csv"
    path.write_text(path.read_text()[:keep])


@pytest.mark.parametrize("keep, check, subject, observed", [
    # a copy that stopped inside a line, one that lacks its last line end, one without a byte
    (-30, "file_fields", "2025_04.csv", 1), (-1, "file_terminated", "2025_04.csv", 0), (0, "monthly_files_missing", "manifest", 1)])
def test_a_half_copied_file_fails_by_name(spark, year, tmp_path, keep, check, subject, observed):  # noqa: F811
    cut(year, 4, keep)
    with pytest.raises(Q.GateError) as e:
        load(spark, year, tmp_path / "w", "run")
    assert (e.value.check, e.value.subject, e.value.observed) == (check, subject, observed)


def test_rows_the_parser_swallows_fail_by_name(spark, year, tmp_path, monkeypatch):  # noqa: F811
    # a file whose rows do not all arrive in staging
    real = P.read_raw
    monkeypatch.setattr(P, "read_raw", lambda s, p: real(s, p).where("NOT (MONTH = '6' AND DAY_OF_MONTH = '9')"))
    with pytest.raises(Q.GateError) as e:
        load(spark, year, tmp_path / "w", "run")
    assert (e.value.check, e.value.subject, e.value.observed, e.value.expected) == ("file_rows", "2025_06.csv", 29, 30)


def test_report_counts_lines_quotes_and_line_ends(spark, tmp_path):
    raw = tmp_path / "raw"
    write_month(raw, 1, every_day(1)[:3])
    text = (raw / "2025_01.csv").read_text()
    (raw / "2025_02.csv").write_bytes(b"\xef\xbb\xbf" + text.replace("\n", "\r\n").encode() + b"\r\n")
    (raw / "2025_03.csv").write_text(text + "\n\n")
    got = {r["file_name"]: r for r in file_report(spark, str(raw)).collect()}
    assert [(got[f"2025_0{m}.csv"]["lines"], got[f"2025_0{m}.csv"]["odd_lines"], got[f"2025_0{m}.csv"]["terminated"],
             got[f"2025_0{m}.csv"]["same_order"]) for m in (1, 2, 3)] == [(4, 0, True, True)] * 3
