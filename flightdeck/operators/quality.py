"""Fail-fast data-quality gates.

Every gate produces rows of one shape::

    check STRING, code INT, subject STRING, observed BIGINT, expected BIGINT, passed BOOLEAN

``code`` is the error number the gate raises with (NULL for gates that carry
no number).  Gates are plain DataFrames, so several can be unioned and
evaluated by one action; scalar counters of one source are fused into a
single aggregation.  :func:`enforce` is the only action: it brings the
(small) failing rows to the driver and raises on the first one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ("check", "code", "subject", "observed", "expected", "passed")


class GateError(RuntimeError):
    """A quality gate failed; ``code`` is the gate's error number."""

    def __init__(self, check: str, code: int | None, subject: str | None,
                 observed: int | None, expected: int | None):
        self.check, self.code, self.subject = check, code, subject
        self.observed, self.expected = observed, expected
        super().__init__(f"[{code}] {check} failed for {subject}: observed {observed}, "
                         f"expected {expected}")


def check_frame(df: DataFrame, check: str, code: int | None, subject: Column | str,
                observed: Column | str, expected: Column | str | int,
                passed: Column | None = None) -> DataFrame:
    """Project ``df`` (already aggregated) to the standard check shape.

    ``passed`` defaults to ``observed <=> expected``.
    """
    def c(x):
        if isinstance(x, Column):
            return x
        if isinstance(x, str):
            return F.col(x)
        return F.lit(x)
    obs = c(observed).cast("bigint")
    exp = c(expected).cast("bigint")
    ok = passed if passed is not None else obs.eqNullSafe(exp)
    subj = subject if isinstance(subject, Column) else F.lit(subject) if not (
        isinstance(subject, str) and subject in df.columns) else F.col(subject)
    return df.select(F.lit(check).alias("check"), F.lit(code).cast("int").alias("code"),
                     subj.cast("string").alias("subject"), obs.alias("observed"),
                     exp.alias("expected"), F.coalesce(ok, F.lit(False)).alias("passed"))


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def checks_from_rows(df: DataFrame, specs: list[tuple]) -> DataFrame:
    """Several checks from every row of ``df`` in ONE pass.

    ``specs``: ``(check, code, subject, observed, expected[, passed])``; a
    string subject is a literal label, a Column is evaluated per row.  All
    checks of a row are built as an array of structs and exploded, so the
    (aggregated) input is computed once however many checks read it.
    """
    structs = []
    for spec in specs:
        check, code, subject, observed, expected = spec[:5]
        passed = spec[5] if len(spec) > 5 else None
        obs = _as_col(observed).cast("bigint")
        exp = _as_col(expected).cast("bigint")
        ok = passed if passed is not None else obs.eqNullSafe(exp)
        subj = subject if isinstance(subject, Column) else F.lit(subject)
        structs.append(F.struct(F.lit(check).alias("check"), F.lit(code).cast("int").alias("code"),
                                subj.cast("string").alias("subject"), obs.alias("observed"),
                                exp.alias("expected"), F.coalesce(ok, F.lit(False)).alias("passed")))
    return df.select(F.inline(F.array(*structs)))


def union_checks(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def enforce(results: DataFrame) -> DataFrame:
    """Raise :class:`GateError` for the first failing row; return ``results``.

    Only failing rows (bounded by the number of checks and subjects) are
    brought to the driver.
    """
    failed = results.filter(~F.col("passed")).orderBy("check", "subject").limit(1).collect()
    if failed:
        r = failed[0]
        raise GateError(r["check"], r["code"], r["subject"], r["observed"], r["expected"])
    return results


# ---------------------------------------------------------------------------
# Reporting period (the reference fixes one year; here it is a parameter)
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402
from dataclasses import dataclass  # noqa: E402

from flightdeck import functions as FN  # noqa: E402
from flightdeck.schemas import (  # noqa: E402
    FACT_GRAIN, FACT_KEYS, FACT_REQUIRED, INTEGER_RANGES, STAGING_COLUMNS, varchar_length,
)


@dataclass(frozen=True)
class Period:
    first_year: int
    last_year: int

    @property
    def years(self) -> list[int]:
        return list(range(self.first_year, self.last_year + 1))

    @property
    def first_date(self) -> _dt.date:
        return _dt.date(self.first_year, 1, 1)

    @property
    def last_date(self) -> _dt.date:
        return _dt.date(self.last_year, 12, 31)

    @property
    def days(self) -> int:
        """Calendar rows expected (365 or 366 per year)."""
        return (self.last_date - self.first_date).days + 1


def _expected_months(spark, period: Period) -> DataFrame:
    """(Year, Month) of the period: 12 rows per year."""
    return (spark.range(period.first_year, period.last_year + 1).select(
        F.col("id").cast("int").alias("Year"))
        .select("Year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month")))


def _ym_subject(y: Column, m: Column) -> Column:
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))


def year_month_coverage(staging: DataFrame, period: Period, date_col: str = "FL_DATE") -> DataFrame:
    """FL_DATE has no NULLs; its years are exactly the period's; months 1..12."""
    d = F.col(date_col)
    a = staging.agg(F.count_if(d.isNull()).alias("nulls"),
                    F.array_sort(F.collect_set(F.year(d))).alias("years"),
                    F.array_sort(F.collect_set(F.month(d))).alias("months"))
    want_years = ",".join(str(y) for y in period.years)
    want_months = ",".join(str(m) for m in range(1, 13))
    yrs = F.array_join(F.col("years").cast("array<string>"), ",")
    mns = F.array_join(F.col("months").cast("array<string>"), ",")
    return checks_from_rows(a, [
        ("date_not_null", None, date_col, "nulls", 0),
        ("expected_years", None, yrs, F.size("years"), len(period.years), yrs == F.lit(want_years)),
        ("expected_months", None, mns, F.size("months"), 12, mns == F.lit(want_months))])


def split_complete(staging: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    """Monthly split: the 12 months of every year present, no row without a month,
    sum = total."""
    per_month = staging.groupBy(F.year(date_col).alias("y"), F.month(date_col).alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    in_range = F.col("m").between(1, 12)
    a = per_month.agg(
        F.count_if(in_range).alias("months_present"),
        (F.count_distinct(F.when(in_range, F.col("y"))) * 12).alias("months_expected"),
        F.coalesce(F.sum(F.when(~F.coalesce(in_range, F.lit(False)), F.col("n"))), F.lit(0))
         .alias("unassigned"),
        F.coalesce(F.sum(F.when(in_range, F.col("n"))), F.lit(0)).alias("split_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"))
    return checks_from_rows(a, [
        ("months_present", None, "split", "months_present", "months_expected"),
        ("unassigned_rows", None, "split", "unassigned", 0),
        ("split_total", None, "split", "split_rows", "total_rows")])


def month_nonempty(staging: DataFrame, period: Period) -> DataFrame:
    """Every (year, month) partition of the period holds rows (50002)."""
    have = staging.groupBy(F.col("YEAR").cast("int").alias("Year"),
                           F.col("MONTH").cast("int").alias("Month")).agg(
        F.count(F.lit(1)).alias("n"))
    return months_filled(have, period)


def months_filled(have: DataFrame, period: Period) -> DataFrame:
    """:func:`month_nonempty` over its counts (Year, Month, n)."""
    exp = _expected_months(have.sparkSession, period)
    j = exp.join(have, ["Year", "Month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return check_frame(j, "month_nonempty", 50002, _ym_subject(F.col("Year"), F.col("Month")),
                       "n", 1, F.col("n") > 0)


def month_purity(staging: DataFrame, date_col: str = "FL_DATE") -> DataFrame:
    """Each (YEAR, MONTH) partition holds only its own year (50003) and month
    (50004) in FL_DATE."""
    d = F.col(date_col)
    g = staging.groupBy(F.col("YEAR").cast("int").alias("Year"),
                        F.col("MONTH").cast("int").alias("Month")).agg(
        F.count_distinct(F.year(d)).alias("years"), F.min(F.year(d)).alias("ylo"),
        F.max(F.year(d)).alias("yhi"), F.count_distinct(F.month(d)).alias("months"),
        F.min(F.month(d)).alias("mlo"), F.max(F.month(d)).alias("mhi"))
    subj = _ym_subject(F.col("Year"), F.col("Month"))
    y_ok = (F.col("years") == 1) & (F.col("ylo") == F.col("Year")) & (F.col("yhi") == F.col("Year"))
    m_ok = (F.col("months") == 1) & (F.col("mlo") == F.col("Month")) & (F.col("mhi") == F.col("Month"))
    return checks_from_rows(g, [("month_year_purity", 50003, subj, "years", 1, y_ok),
                                ("month_month_purity", 50004, subj, "months", 1, m_ok)])


def all_months(staging: DataFrame, period: Period) -> DataFrame:
    """All months of the period present (50005); observed = months with rows."""
    a = staging.agg(F.count_distinct(F.col("YEAR"), F.col("MONTH")).alias("n"),
                    F.count(F.lit(1)).alias("rows"))
    return checks_from_rows(a, [("all_months", 50005, "staging", "n", 12 * len(period.years)),
                                ("staging_rows", None, "staging", "rows", F.lit(None), F.col("rows") > 0)])


def lookups(missing: DataFrame) -> DataFrame:
    """Source non-empty (50020) and every lookup resolved (50021), from
    ``fact.missing_lookups`` output."""
    specs = [("source_not_empty", 50020, "staging", "total_rows", 1, F.col("total_rows") > 0)]
    for dim in ("date", "airline", "origin", "destination"):
        specs.append(("lookup_resolved", 50021, dim, f"missing_{dim}", 0))
    return checks_from_rows(missing, specs)


def row_reconciliation(staging: DataFrame, fact: DataFrame, code: int = 50022) -> DataFrame:
    """Loaded fact rows equal staging rows: 50022 inside the load, 50030 after it."""
    s = staging.select(F.lit("s").alias("_side"))
    f = fact.select(F.lit("f").alias("_side"))
    # one aggregation over both inputs: no join between the two counts
    both = s.unionByName(f).agg(F.count_if(F.col("_side") == "s").alias("s"),
                                F.count_if(F.col("_side") == "f").alias("f"))
    return check_frame(both, "row_reconciliation", code, F.lit("fact"), "f", "s")


def calendar(dates: DataFrame, period: Period) -> DataFrame:
    """Calendar rows = days of the period (50031) and its bounds (50032)."""
    a = dates.agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("lo"), F.max("Date").alias("hi"))
    first = FN.date_key(F.lit(period.first_date))
    last = FN.date_key(F.lit(period.last_date))
    return checks_from_rows(a, [
        ("calendar_rows", 50031, "dim_date", "n", period.days),
        ("calendar_first_day", 50032, "dim_date", FN.date_key("lo"), first),
        ("calendar_last_day", 50032, "dim_date", FN.date_key("hi"), last)])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys occurring more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter(
        F.col("duplicate_count") > 1)


def _dup_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))


def dim_unique(airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """Business keys unique in the airline (50033) and airport (50034) dims."""
    return union_checks(
        check_frame(_dup_count(airlines, ["DOTAirlineID"]), "dim_unique", 50033,
                    F.lit("dim_airline"), "n", 0),
        check_frame(_dup_count(airports, ["AirportID"]), "dim_unique", 50034,
                    F.lit("dim_airport"), "n", 0))


def grain_unique(fact: DataFrame, grain: tuple[str, ...] = FACT_GRAIN) -> DataFrame:
    """No two fact rows share the 6-column grain (50035)."""
    return check_frame(_dup_count(fact, list(grain)), "grain_unique", 50035, F.lit("fact"), "n", 0)


def referential(fact: DataFrame, dates: DataFrame, airlines: DataFrame,
                airports: DataFrame) -> DataFrame:
    """Every fact foreign key has its dimension row (50036); one left-join pass."""
    d = F.broadcast(dates.select(F.col("DateKey").alias("_dk")))
    a = airlines.select(F.col("AirlineKey").alias("_ak"))
    o = airports.select(F.col("AirportKey").alias("_ok"))
    t = airports.select(F.col("AirportKey").alias("_tk"))
    j = (fact.select(*FACT_KEYS)
         .join(d, F.col("DateKey") == F.col("_dk"), "left")
         .join(a, F.col("AirlineKey") == F.col("_ak"), "left")
         .join(o, F.col("OriginAirportKey") == F.col("_ok"), "left")
         .join(t, F.col("DestinationAirportKey") == F.col("_tk"), "left"))
    agg = j.agg(*[F.count_if(F.col(c).isNull()).alias(k)
                  for c, k in (("_dk", "DateKey"), ("_ak", "AirlineKey"),
                               ("_ok", "OriginAirportKey"), ("_tk", "DestinationAirportKey"))])
    return checks_from_rows(agg, [("referential", 50036, k, k, 0) for k in FACT_KEYS])


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One aggregation -> one row per column: (column_name, null_count)."""
    a = df.agg(F.count(F.lit(1)).alias("_rows"),
               *[F.count(F.col(c)).alias(f"_v{i}") for i, c in enumerate(columns)])
    return a.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"_v{i}")).alias("null_count"))
        for i, c in enumerate(columns)])))


def required_nulls(fact: DataFrame, columns: tuple[str, ...] = FACT_REQUIRED) -> DataFrame:
    """Required fact columns contain no NULL (50037)."""
    return check_frame(null_counts(fact, list(columns)), "required_not_null", 50037,
                       "column_name", "null_count", 0)


def monthly_recon(recon: DataFrame) -> DataFrame:
    """Per month: fact rows equal staging rows (50038) -- over a
    ``monthly_reconciliation`` frame."""
    return check_frame(recon, "monthly_reconciliation", 50038,
                       _ym_subject(F.col("Year"), F.col("Month")),
                       F.coalesce("fact_rows", F.lit(0)), "staging_rows")


def fact_date_range(fact: DataFrame, dates: DataFrame, period: Period) -> DataFrame:
    """No fact row dated outside the period (50039)."""
    per_key = fact.groupBy("DateKey").agg(F.count(F.lit(1)).alias("_n"))
    j = per_key.join(F.broadcast(dates.select("DateKey", "Date")), "DateKey")
    outside = ~F.col("Date").between(F.lit(period.first_date), F.lit(period.last_date))
    a = j.agg(F.coalesce(F.sum(F.when(outside, F.col("_n"))), F.lit(0)).alias("n"))
    return check_frame(a, "fact_date_range", 50039, F.lit("fact"), "n", 0)


def declared_constraints(staging: DataFrame, dates: DataFrame, airlines: DataFrame,
                         airports: DataFrame, fact: DataFrame) -> DataFrame:
    """Constraints the warehouse DDL declares, as checks:

    primary / unique keys of every table, NOT NULL staging columns, text
    length limits and small-integer ranges of the staging columns (one
    aggregation over staging for the column-level ones).
    """
    keys = union_checks(
        check_frame(_dup_count(dates, ["DateKey"]), "primary_key", None, F.lit("dim_date.DateKey"), "n", 0),
        check_frame(_dup_count(dates, ["Date"]), "unique_key", None, F.lit("dim_date.Date"), "n", 0),
        check_frame(_dup_count(airlines, ["AirlineKey"]), "primary_key", None,
                    F.lit("dim_airline.AirlineKey"), "n", 0),
        check_frame(_dup_count(airports, ["AirportKey"]), "primary_key", None,
                    F.lit("dim_airport.AirportKey"), "n", 0),
        check_frame(_dup_count(fact, ["FlightKey"]), "primary_key", None, F.lit("fact.FlightKey"), "n", 0))
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(STAGING_COLUMNS):
        col = F.col(c.name)
        if not c.nullable:
            aggs.append(F.count(col).alias(f"nn{i}"))
            rows.append(("not_null", c.name, F.col("_rows") - F.col(f"nn{i}")))
        n = varchar_length(c.sql_type)
        if n is not None:
            aggs.append(F.count_if(F.length(col) > n).alias(f"ln{i}"))
            rows.append(("text_length", c.name, f"ln{i}"))
        if c.sql_type in ("TINYINT", "SMALLINT"):
            lo, hi = INTEGER_RANGES[c.sql_type]
            aggs.append(F.count_if(~col.cast("int").between(lo, hi)).alias(f"rg{i}"))
            rows.append(("integer_range", c.name, f"rg{i}"))
    cols = checks_from_rows(staging.agg(*aggs), [(k, None, n, a, 0) for k, n, a in rows])
    return keys.unionByName(cols)



def require_date_type(df: DataFrame, column: str = "FL_DATE") -> DataFrame:
    """The date column must already be a DATE before the monthly split (schema
    check, no data is read)."""
    from pyspark.sql import types as T
    if not isinstance(df.schema[column].dataType, T.DateType):
        raise GateError("date_type", None, column, None, None)
    return df


def manifest_checks(manifest: DataFrame) -> DataFrame:
    """Monthly file gate over ``sources.files.file_manifest`` output: no
    expected month without a file, and the count of files found (extra
    months are reported, not failed)."""
    a = manifest.agg(F.count_if(F.col("status") == "missing").alias("missing"),
                     F.count_if(F.col("status") == "extra").alias("extra"),
                     F.count_if(F.col("status") == "unrecognised").alias("unrecognised"),
                     F.count_if(F.col("status").isin("missing", "present")).alias("expected"),
                     F.count_if(F.col("status") == "present").alias("present"))
    return checks_from_rows(a, [("monthly_files_missing", None, "manifest", "missing", 0),
                                ("monthly_files_present", None, "manifest", "present", "expected"),
                                ("monthly_files_unrecognised", None, "manifest", "unrecognised", 0),
                                ("monthly_files_extra", None, "manifest", "extra", F.lit(None), F.lit(True))])


def header_checks(report: DataFrame) -> DataFrame:
    """Header gate over ``sources.files.header_report`` output, a row for each file."""
    bad = F.col("missing_columns") + F.col("extra_columns") + F.when(F.col("same_order"), 0).otherwise(1)
    return check_frame(report.withColumn("_bad", bad), "header_matches", None,
                       _ym_subject(F.col("file_year"), F.col("file_month")), "_bad", 0)
