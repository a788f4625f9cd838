"""Month refresh by file state: new, changed, deleted and unchanged files."""

import os
import pathlib

import pytest

from flightdeck.sources import file_state as FS
from flightdeck.streaming.monthly_files import load_new_months, refresh_changed_months
from test_load_pipeline import every_day, write_month


@pytest.fixture
def place(tmp_path):
    return tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")


def actions(report):
    return {r["file_month"]: r["action"] for r in report.collect()}


def rows(spark, out):
    return {r["file_month"]: r["count"] for r in spark.read.parquet(out).groupBy("file_month").count().collect()}


def written(out, month):
    return {(p.name, p.stat().st_mtime_ns) for p in pathlib.Path(f"{out}/file_year=2025/file_month={month}").iterdir()}


def test_only_touched_months_are_rewritten(spark, place):
    raw, out, state = place
    for month in (1, 2, 3, 4):
        write_month(raw, month, every_day(month))
    assert set(actions(refresh_changed_months(spark, str(raw), out, state)).values()) == {"load"}
    before = {m: written(out, m) for m in (1, 2, 3, 4)}
    # the second month again, under its own name, with fewer rows; a second file for the third; a new fifth
    write_month(raw, 2, every_day(2)[:6])
    write_month(raw / "more", 3, every_day(3)[:1])
    write_month(raw, 5, every_day(5)[:2])
    report = refresh_changed_months(spark, str(raw), out, state)
    assert actions(report) == {1: "keep", 2: "load", 3: "load", 4: "keep", 5: "load"}
    two = report.where("file_month = 2").first()
    assert (two["new_files"], two["changed_files"], two["deleted_files"], two["unchanged_files"]) == (0, 1, 0, 0)
    assert rows(spark, out) == {1: 31, 2: 6, 3: 32, 4: 30, 5: 2}
    assert [written(out, m) == before[m] for m in (1, 2, 3, 4)] == [True, False, False, True]
    # one of the third month's files goes: the rest is its whole content
    (raw / "more" / "2025_03.csv").unlink()
    report = refresh_changed_months(spark, str(raw), out, state)
    assert report.where("file_month = 3").first()["deleted_files"] == 1
    assert rows(spark, out)[3] == 31
    assert set(actions(refresh_changed_months(spark, str(raw), out, state)).values()) == {"keep"}


def test_same_length_and_name_is_seen_by_its_time(spark, place):
    raw, out, state = place
    write_month(raw, 1, every_day(1))
    refresh_changed_months(spark, str(raw), out, state)
    text = (raw / "2025_01.csv").read_text()
    (raw / "2025_01.csv").write_text(text.replace("N123DL", "N999DL"))
    os.utime(raw / "2025_01.csv", (2_000_000_000, 2_000_000_000))
    assert actions(refresh_changed_months(spark, str(raw), out, state)) == {1: "load"}
    assert {r[0] for r in spark.read.parquet(out).select("TAIL_NUM").distinct().collect()} == {"N999DL"}


def test_a_vanished_month_is_reported_until_it_is_dropped(spark, place):
    raw, out, state = place
    for month in (1, 2):
        write_month(raw, month, every_day(month))
    refresh_changed_months(spark, str(raw), out, state)
    (raw / "2025_02.csv").unlink()
    for _ in range(2):
        assert actions(refresh_changed_months(spark, str(raw), out, state)) == {1: "keep", 2: "vanished"}
        assert rows(spark, out) == {1: 31, 2: 28}
    assert actions(refresh_changed_months(spark, str(raw), out, state, drop_vanished=True))[2] == "vanished"
    assert rows(spark, out) == {1: 31}
    assert actions(refresh_changed_months(spark, str(raw), out, state)) == {1: "keep"}


def test_a_failed_refresh_is_repeated(spark, place):
    raw, out, state = place
    write_month(raw, 1, every_day(1))
    refresh_changed_months(spark, str(raw), out, state)
    write_month(raw, 1, every_day(2))
    with pytest.raises(Exception, match="another month"):
        refresh_changed_months(spark, str(raw), out, state)
    assert rows(spark, out) == {1: 31}
    write_month(raw, 1, every_day(1)[:3])
    refresh_changed_months(spark, str(raw), out, state)
    assert rows(spark, out) == {1: 3}
    # an unfinished state is not read
    newest = pathlib.Path(state) / f"v{FS._versions(spark, state)[-1] + 1}"
    newest.mkdir()
    assert FS.read_state(spark, state).count() == 1


def test_file_without_a_month_raises(spark, place):
    raw, out, state = place
    write_month(raw, 1, every_day(1), name="january.csv")
    with pytest.raises(ValueError, match="no month"):
        refresh_changed_months(spark, str(raw), out, state)


def test_stream_sees_a_month_delivered_again(spark, place):
    raw, out, state = place
    write_month(raw, 1, every_day(1)[:9])
    load_new_months(spark, str(raw), out, state)
    assert rows(spark, out) == {1: 9}
    write_month(raw, 1, every_day(1)[:6])
    assert actions(load_new_months(spark, str(raw), out, state)) == {1: "load"}
    assert rows(spark, out) == {1: 6}
