"""Raw -> staging conversion and every gate shown to pass and to fail."""

import pytest
from pyspark.sql import functions as F

from conftest import month_rows, raw_row
from flightdeck.operators import clean as CL
from flightdeck.operators import fact as FT
from flightdeck.operators import quality as Q
from flightdeck.plans.pipeline import build_warehouse
from flightdeck.schemas import STAGING_NAMES, staging_schema

PERIOD = Q.Period(2025, 2025)


def failed(checks, check=None):
    df = checks.filter(~F.col("passed"))
    if check:
        df = df.filter(F.col("check") == check)
    return [tuple(r) for r in df.select("check", "code", "subject").collect()]


def test_clean_types_and_values(spark, raw_df):
    stg = CL.clean(raw_df([raw_row(TAIL_NUM="NA", CANCELLED="1.0", CANCELLATION_CODE="A",
                                   DEP_TIME=None, ARR_DELAY=None, ARR_DEL15=None)]))
    assert [f.dataType for f in stg.schema.fields] == [f.dataType for f in staging_schema().fields]
    r = stg.first()
    assert r["TAIL_NUM"] is None and r["CANCELLED"] is True and r["DEP_TIME"] is None
    assert str(r["FL_DATE"]) == "2025-01-01" and r["CRS_DEP_TIME"] == "05:30"
    assert r["DEP_DELAY"] == 5 and r["DISTANCE"] == 1946 and r["ARR_DELAY"] is None


def test_conversion_gates_pass_on_clean_rows(spark, raw_df):
    checks = CL.conversion_checks(CL.conversion_report(raw_df(month_rows())))
    assert failed(checks) == []
    Q.enforce(checks)


@pytest.mark.parametrize("over, check, column", [
    ({"DEP_TIME": "2401"}, "clock_valid", "DEP_TIME"),
    ({"CRS_ARR_TIME": "1260"}, "clock_valid", "CRS_ARR_TIME"),
    ({"FL_DATE": "13/1/2025 12:00:00 AM"}, "conversion_failures", "FL_DATE"),
    ({"DISTANCE": "x"}, "conversion_failures", "DISTANCE"),
    ({"TAXI_OUT": "7.5"}, "conversion_failures", "TAXI_OUT"),
    ({"TAXI_OUT": "7.5"}, "null_preserved", "TAXI_OUT"),
])
def test_conversion_gates_fail(spark, raw_df, over, check, column):
    checks = CL.conversion_checks(CL.conversion_report(raw_df(month_rows() + [raw_row(**over)])))
    assert (check, None, column) in failed(checks)
    with pytest.raises(Q.GateError):
        Q.enforce(checks)


def wh_of(raw):
    stg = CL.clean(raw)
    return build_warehouse(stg)


def test_warehouse_gates_pass(spark, raw_df):
    wh = wh_of(raw_df(month_rows()))
    fact = wh.fact
    keys = FT.resolve_keys(wh.staging, wh.dates, wh.airlines, wh.airports)
    from flightdeck.plans.q_fact import monthly_reconciliation
    checks = Q.union_checks(
        Q.year_month_coverage(wh.staging, PERIOD), Q.split_complete(wh.staging),
        Q.month_nonempty(wh.staging, PERIOD), Q.month_purity(wh.staging),
        Q.all_months(wh.staging, PERIOD),
        Q.lookups(FT.missing_lookups(wh.staging, wh.dates, wh.airlines, wh.airports)),
        Q.row_reconciliation(wh.staging, fact), Q.dim_unique(wh.airlines, wh.airports),
        Q.grain_unique(fact), Q.referential(fact, wh.dates, wh.airlines, wh.airports),
        Q.required_nulls(fact), Q.monthly_recon(monthly_reconciliation(wh.staging, keys, wh.dates)),
        Q.fact_date_range(fact, wh.dates, PERIOD))
    assert failed(checks) == []
    # the calendar spans only flight dates: 2025-01-01 .. 2025-12-01 here
    assert {r[0] for r in failed(Q.calendar(wh.dates, PERIOD))} == {"calendar_rows", "calendar_last_day"}


def test_month_gates_fail(spark, raw_df):
    rows = month_rows(months=range(1, 12))                       # December missing
    rows.append(raw_row(MONTH="3", FL_DATE="4/2/2025 12:00:00 AM"))  # April date in March file
    rows.append(raw_row(YEAR="2025", MONTH="5", FL_DATE="5/2/2024 12:00:00 AM"))  # 2024 row
    stg = CL.clean(raw_df(rows))
    assert ("month_nonempty", 50002, "2025-12") in failed(Q.month_nonempty(stg, PERIOD))
    purity = failed(Q.month_purity(stg))
    assert ("month_month_purity", 50004, "2025-03") in purity
    assert ("month_year_purity", 50003, "2025-05") in purity
    assert failed(Q.all_months(stg, PERIOD)) == [("all_months", 50005, "staging")]
    assert {c for c, _, _ in failed(Q.year_month_coverage(stg, PERIOD))} == {"expected_years",
                                                                           "expected_months"}


def test_lookup_gate_fails_on_unknown_airport(spark, raw_df):
    wh = wh_of(raw_df(month_rows()))
    extra = CL.clean(raw_df([raw_row(DEST_AIRPORT_ID="99999")]))
    stg = wh.staging.unionByName(extra)
    res = failed(Q.lookups(FT.missing_lookups(stg, wh.dates, wh.airlines, wh.airports)))
    assert res == [("lookup_resolved", 50021, "destination")]
    # the inner join drops the row: reconciliation catches it
    fact = FT.fact_flights(stg, wh.dates, wh.airlines, wh.airports)
    assert failed(Q.row_reconciliation(stg, fact)) == [("row_reconciliation", 50022, "fact")]


def test_source_not_empty_uses_zero_not_null(spark, raw_df):
    wh = wh_of(raw_df(month_rows()))
    empty = wh.staging.limit(0)
    res = failed(Q.lookups(FT.missing_lookups(empty, wh.dates, wh.airlines, wh.airports)))
    assert res == [("source_not_empty", 50020, "staging")]


def test_grain_and_required_and_dim_gates_fail(spark, raw_df):
    rows = month_rows() + [month_rows()[0]]                      # duplicated grain row
    wh = wh_of(raw_df(rows))
    fact = wh.fact
    assert failed(Q.grain_unique(fact)) == [("grain_unique", 50035, "fact")]
    broken = fact.withColumn("DistanceMiles", F.when(F.col("FlightKey") == 1, None)
                             .otherwise(F.col("DistanceMiles")))
    assert failed(Q.required_nulls(broken)) == [("required_not_null", 50037, "DistanceMiles")]
    dup_dim = wh.airlines.unionByName(wh.airlines)
    assert ("dim_unique", 50033, "dim_airline") in failed(Q.dim_unique(dup_dim, wh.airports))
    orphan = fact.withColumn("AirlineKey", F.lit(999))
    assert failed(Q.referential(orphan, wh.dates, wh.airlines, wh.airports)) == [
        ("referential", 50036, "AirlineKey")]
    assert failed(Q.fact_date_range(fact, wh.dates, Q.Period(2024, 2024))) == [
        ("fact_date_range", 50039, "fact")]


def test_declared_constraints(spark, raw_df):
    wh = wh_of(raw_df(month_rows() + [raw_row(ORIGIN="ATLX", DAY_OF_MONTH="300")]))
    res = failed(Q.declared_constraints(wh.staging, wh.dates, wh.airlines, wh.airports, wh.fact))
    assert ("text_length", None, "ORIGIN") in res
    assert ("integer_range", None, "DAY_OF_MONTH") in res


def test_split_complete(spark, raw_df):
    stg = CL.clean(raw_df(month_rows()))
    assert failed(Q.split_complete(stg)) == []
    with_null = stg.unionByName(stg.limit(1).withColumn("FL_DATE", F.lit(None).cast("date")))
    assert ("unassigned_rows", None, "split") in failed(Q.split_complete(with_null))


def test_staging_columns_in_order(spark, raw_df):
    assert CL.clean(raw_df(month_rows())).columns == list(STAGING_NAMES)


def test_date_type_required_before_split(spark, raw_df):
    raw = raw_df(month_rows(months=[1]))
    with pytest.raises(Q.GateError):
        Q.require_date_type(raw)
    Q.require_date_type(CL.clean(raw))


def test_namespaces_are_stable(spark):
    from flightdeck.sinks.tables import namespaces
    a, b = namespaces(spark, "/x/wh"), namespaces(spark, "/x/wh/")
    assert a == b == {"staging": "/x/wh/staging", "dim": "/x/wh/dim", "fact": "/x/wh/fact",
                      "analytics": "/x/wh/analytics"}
