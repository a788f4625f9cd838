"""End-to-end load: a year of monthly files, and every way it must stop."""

import pytest
from pyspark.sql import functions as F

from conftest import month_rows, raw_row
from flightdeck.operators import dims as D
from flightdeck.operators import quality as Q
from flightdeck.plans.pipeline import LoadConfig, run_pipeline
from flightdeck.schemas import STAGING_NAMES
from flightdeck.sinks.files import read_published
from flightdeck.sources import files as SR
from flightdeck.streaming.monthly_files import load_new_months

PERIOD = Q.Period(2025, 2025)


def write_month(folder, month, rows, header=STAGING_NAMES, name=None):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header)]
    for r in rows:
        lines.append(",".join("" if v is None else f'"{v}"' if "," in v or " " in v else v for v in r))
    (folder / (name or f"2025_{month:02d}.csv")).write_text("\n".join(lines) + "\n")


def every_day(month):
    import calendar
    import datetime
    rows = []
    for day in range(1, calendar.monthrange(2025, month)[1] + 1):
        d = datetime.date(2025, month, day)
        rows.append(raw_row(YEAR="2025", MONTH=str(month), QUARTER=str((month - 1) // 3 + 1), DAY_OF_MONTH=str(day),
                            DAY_OF_WEEK=str(d.isoweekday()), FL_DATE=f"{month}/{day}/2025 12:00:00 AM"))
    return rows


@pytest.fixture
def year(tmp_path):
    raw = tmp_path / "raw"
    for m in range(1, 13):
        write_month(raw, m, every_day(m))
    return raw


def load(spark, raw, root, run_id):
    return run_pipeline(spark, LoadConfig(str(raw), PERIOD, str(root), run_id))


def test_load_publishes_and_a_bad_load_changes_nothing(spark, year, tmp_path):
    root = tmp_path / "warehouse"
    done = load(spark, year, root, "first")
    assert done.fact.count() == 365 and done.checks.where("NOT passed").count() == 0
    assert {"50022", "50030", "50005"} <= {str(r[0]) for r in done.checks.select("code").distinct().collect()}
    folders = {p.name for p in (root / "staging" / "first" / "flights" / "YEAR=2025").iterdir()}
    assert folders == {f"MONTH={m}" for m in range(1, 13)}
    # a clock that does not exist
    write_month(year, 3, [*every_day(3), raw_row(MONTH="3", FL_DATE="3/1/2025 12:00:00 AM", DEP_TIME="2575",
                                                 OP_CARRIER_FL_NUM="9")])
    with pytest.raises(Q.GateError) as e:
        load(spark, year, root, "second")
    assert e.value.check == "clock_valid"
    assert read_published(spark, f"{root}/published").count() == 365
    # a flight twice: the grain gate runs on the written fact
    write_month(year, 3, [*every_day(3), every_day(3)[0]])
    with pytest.raises(Q.GateError) as e:
        load(spark, year, root, "third")
    assert e.value.code == 50035
    assert read_published(spark, f"{root}/published").count() == 365


@pytest.mark.parametrize("spoil, check", [
    (lambda raw: (raw / "2025_04.csv").unlink(), "monthly_files_missing"),
    (lambda raw: write_month(raw, 4, every_day(4), name="april.csv"), "monthly_files_unrecognised"),
    (lambda raw: write_month(raw, 4, every_day(4), header=[*STAGING_NAMES[1::-1], *STAGING_NAMES[2:]]), "header_matches"),
])
def test_bad_files_stop_the_load(spark, year, tmp_path, spoil, check):
    spoil(year)
    with pytest.raises(Q.GateError) as e:
        load(spark, year, tmp_path / "w", "run")
    assert e.value.check == check


def test_manifest_and_headers_of_flat_files(spark, tmp_path):
    raw = tmp_path / "raw"
    write_month(raw, 1, every_day(1)[:1])
    write_month(raw, 2, every_day(2)[:1], header=[f"extra{i}" for i in range(12_000)] + list(STAGING_NAMES))
    write_month(raw, 3, every_day(3)[:1], name="2024_03.csv")
    write_month(raw, 4, every_day(4)[:1], name="notes.csv")
    got = {(r.file_year, r.file_month): r.status for r in SR.file_manifest(spark, str(raw), 2025, 2025).collect()}
    assert got[2025, 1] == "present" and got[2025, 3] == "missing" and got[2024, 3] == "extra"
    assert got[None, None] == "unrecognised" and len(got) == 14
    heads = {r.file_month: r for r in SR.header_report(spark, str(raw)).where("file_year = 2025").collect()}
    assert heads[1].same_order and heads[2].extra_columns == 12_000 and not heads[2].same_order


def test_stream_keeps_months_of_many_files(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    for n in range(3):
        write_month(raw / f"part{n}", 1, every_day(1)[2 * n:2 * n + 2])
    load_new_months(spark, str(raw), out, state, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 6
    write_month(raw / "late", 1, every_day(1)[10:11])
    load_new_months(spark, str(raw), out, state)
    assert spark.read.parquet(out).count() == 7


def test_stream_fails_on_a_short_row_or_a_foreign_month(spark, tmp_path):
    raw = tmp_path / "raw"
    write_month(raw, 1, [("2025", "1")])
    with pytest.raises(Exception):  # noqa: B017  Spark wraps it
        load_new_months(spark, str(raw), str(tmp_path / "out"), str(tmp_path / "state"))
    other = tmp_path / "other"
    write_month(other, 1, every_day(2))
    with pytest.raises(Exception, match="another month"):
        load_new_months(spark, str(other), str(tmp_path / "out2"), str(tmp_path / "state2"))


def test_upsert_refuses_a_key_twice(spark):
    target = spark.createDataFrame([(1, 10, "a")], "k int, id int, v string")
    source = spark.createDataFrame([(20, "x"), (20, "y")], "id int, v string")
    with pytest.raises(Exception, match="more than once"):
        D.upsert(target, source, ["id"], ["v"], "k").collect()
    merged = D.upsert(target, source.dropDuplicates(["id"]), ["id"], ["v"], "k")
    assert sorted((r.k, r.id, r._action) for r in merged.collect()) == [(1, 10, "keep"), (2, 20, "insert")]


def test_month_gates_see_each_year(spark, raw_df):
    from flightdeck.operators.clean import clean
    staging = clean(raw_df(month_rows(2025) + month_rows(2026, months=range(1, 12))))
    bad = Q.split_complete(staging).where(~F.col("passed")).collect()
    assert [r["check"] for r in bad] == ["months_present"]
