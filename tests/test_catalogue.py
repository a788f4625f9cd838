"""Driver contract, plan shapes and DuckDB oracle agreement on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SAMPLE = ["airline_matrix", "overview_cards", "monthly_on_time", "busiest_routes_otr",
          "topn_with_ties", "hhmm_to_time", "parse_flight_date", "strict_integer", "dim_date",
          "airport_latest", "merge_dim_airline", "fact_flights", "check_lookups",
          "check_declared_constraints", "null_profile", "value_set_unchanged", "rt_typed_scan",
          "rt_partition_refresh", "stratified_sample", "conversion_report", "merge_dim_airport",
          "union_months", "month_slice", "monthly_reconciliation_defective", "load_gates_defective",
          "check_split_complete", "check_all_months", "check_file_manifest", "rt_sample_export",
          "rt_stream_month_load"]


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "on_time_rate_highlight" in df.columns


def test_every_query_has_an_oracle():
    from flightdeck.plans import registry
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data queries, where present, add to these
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(q)
    assert len(registry.QUERIES) >= 137


def _norm(v):
    import datetime
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_agrees(spark, duck, name):
    sdf = E.queries()[name](spark, SMOKE)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    srows = sorted((tuple(_norm(r[i]) for i in si) for r in sdf.collect()), key=repr)
    drows = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=repr)
    assert srows == drows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    q = E.queries()
    top = q["top10_origin_volume"](spark, SMOKE)
    top.collect()
    assert "TakeOrderedAndProject" in _plan(top) or "takeordered" in _plan(top).lower()
    samp = q["stratified_sample"](spark, SMOKE)
    samp.collect()
    assert "WindowGroupLimit" in _plan(samp)
    for name in ("airline_matrix", "route_kpis", "check_referential", "fact_key_resolution"):
        df = q[name](spark, SMOKE)
        df.collect()
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scan_prunes_columns(spark):
    df = E.queries()["kpi_on_time_rate"](spark, SMOKE)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in txt or "FileScan" in txt or "Scan parquet" in txt
    assert "op_carrier_fl_num" not in txt.split("ReadSchema")[-1] if "ReadSchema" in txt else True
