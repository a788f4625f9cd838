"""Gates fused into one pass per table.

The gates of :mod:`flightdeck.operators.quality` each aggregate the table they look
at.  A load asks all of them at once, so here every gate on a table gives the counters
that it needs, one aggregation counts them all at the grain that the finest gate needs
(a calendar month of staging, a date of the fact), and the gates' rows are then made
from the few stored rows of counters.  The rows equal those of the single gates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck.operators import quality as Q
from flightdeck.schemas import FACT_KEYS, FACT_REQUIRED
from flightdeck.sinks.tables import store


class Counters:
    """Counters that gates ask for over one table, counted together.

    ``need(column)`` takes an aggregate and returns the name of its counter; a counter
    that two gates ask for is counted once.  ``count`` runs one aggregation at the
    grain and keeps its rows, which all gates then read.
    """

    def __init__(self, table: DataFrame, grain: dict[str, Column]):
        self.table, self.grain = table, grain
        self.columns: dict[str, Column] = {}
        self.names: dict[str, str] = {}

    def need(self, what: Column) -> str:
        name = self.names.setdefault(str(what), f"n{len(self.names)}")
        self.columns[name] = what
        return name

    def plan(self) -> DataFrame:
        return self.table.groupBy(*[c.alias(n) for n, c in self.grain.items()]).agg(
            *[c.alias(n) for n, c in self.columns.items()])

    def count(self) -> DataFrame:
        return store(self.plan(), "gate-counters")


def total(name: str) -> Column:
    """A counter's sum over all groups; 0 over an empty table."""
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def staging_gates(staging: DataFrame, period: Q.Period) -> tuple[DataFrame, DataFrame]:
    """(checks of K5, K6 and K8-K10, rows per calendar month) in one pass over staging.

    The checks of ``year_month_coverage``, ``split_complete``, ``month_nonempty``,
    ``month_purity`` and ``all_months``, which look at the file's month columns and the
    date's month only: one group for each combination of both, and in it a count.
    """
    grain = {"YEAR": F.col("YEAR"), "MONTH": F.col("MONTH"), "y": F.year("FL_DATE"), "m": F.month("FL_DATE")}
    counters = Counters(staging, grain)
    n = counters.need(F.count(F.lit(1)))
    counted = counters.count().withColumnRenamed(n, "n")
    # a row for each group stands for its rows: weigh the counts, keep the sets
    whole = counted.agg(
        total("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("y").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.array_sort(F.collect_set("y")).alias("years"), F.array_sort(F.collect_set("m")).alias("months"),
        F.count_distinct(F.when(F.col("m").isNotNull(), F.struct("y", "m"))).alias("months_present"),
        (F.count_distinct(F.when(F.col("m").isNotNull(), F.col("y"))) * 12).alias("months_expected"),
        F.coalesce(F.sum(F.when(F.col("m").isNotNull(), F.col("n"))), F.lit(0)).alias("split_rows"),
        F.count_distinct("YEAR", "MONTH").alias("file_months"))
    years, months = (F.array_join(F.col(c).cast("array<string>"), ",") for c in ("years", "months"))
    want_years, want_months = (",".join(map(str, v)) for v in (period.years, range(1, 13)))
    sums = Q.checks_from_rows(whole, [
        ("date_not_null", None, "FL_DATE", "nulls", 0),
        ("expected_years", None, years, F.size("years"), len(period.years), years == F.lit(want_years)),
        ("expected_months", None, months, F.size("months"), 12, months == F.lit(want_months)),
        ("months_present", None, "split", "months_present", "months_expected"),
        ("unassigned_rows", None, "split", "nulls", 0),
        ("split_total", None, "split", "split_rows", "rows"),
        ("all_months", 50005, "staging", "file_months", 12 * len(period.years)),
        ("staging_rows", None, "staging", "rows", F.lit(None), F.col("rows") > 0)])
    have = counted.groupBy(F.col("YEAR").cast("int").alias("Year"), F.col("MONTH").cast("int").alias("Month")).agg(
        total("n").alias("n"))
    # purity looks at which months occur under a file's month
    dated = counted.withColumn("FL_DATE", F.make_date("y", "m", F.lit(1)))
    return Q.union_checks(sums, Q.months_filled(have, period), Q.month_purity(dated)), counted


def fact_counters(fact: DataFrame, airlines: DataFrame, airports: DataFrame) -> Counters:
    """Counters of the fact's gates at date grain, over one read of it.

    The dimension keys are looked up by left joins; the calendar's is looked up per
    date afterwards, for the date is the grain.
    """
    a = airlines.select(F.col("AirlineKey").alias("_a"))
    o, d = (airports.select(F.col("AirportKey").alias(c)) for c in ("_o", "_d"))
    columns = list(dict.fromkeys((*FACT_KEYS, *FACT_REQUIRED)))
    rows = (fact.select(*columns).join(a, F.col("AirlineKey") == F.col("_a"), "left")
            .join(o, F.col("OriginAirportKey") == F.col("_o"), "left")
            .join(d, F.col("DestinationAirportKey") == F.col("_d"), "left"))
    return Counters(rows, {"DateKey": F.col("DateKey")})


def fact_gates(fact: DataFrame, dates: DataFrame, airlines: DataFrame, airports: DataFrame,
               staging_months: DataFrame, period: Q.Period) -> DataFrame:
    """Checks 50030 and 50036-50039 in one pass over the fact.

    ``staging_months``: the second result of :func:`staging_gates`.  Grain uniqueness
    (50035) needs rows dealt by the grain and is a gate of its own.
    """
    counters = fact_counters(fact, airlines, airports)
    n = counters.need(F.count(F.lit(1)))
    lost = {k: counters.need(F.count_if(F.col(c).isNull()))
            for k, c in (("AirlineKey", "_a"), ("OriginAirportKey", "_o"), ("DestinationAirportKey", "_d"))}
    filled = {c: counters.need(F.count(c)) for c in FACT_REQUIRED}
    # at most 366 rows a year on either side
    by_date = store(counters.count().join(dates.select(F.col("DateKey").alias("_k"), "Date", "Year", "Month"),
                                          F.col("DateKey") == F.col("_k"), "left"), "fact-counters")
    outside = ~F.col("Date").between(F.lit(period.first_date), F.lit(period.last_date))

    def where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0)).cast("bigint")
    whole = by_date.agg(
        total(n).alias("rows"), where(F.col("_k").isNull()).alias("lost_DateKey"), where(outside).alias("outside"),
        *[total(c).alias(f"lost_{k}") for k, c in lost.items()], *[total(c).alias(f"filled_{k}") for k, c in filled.items()])
    staged = staging_months.agg(total("n").alias("staged"))
    # one row each: brought together without a join
    both = (whole.withColumn("staged", F.lit(None).cast("bigint"))
            .unionByName(staged, allowMissingColumns=True))
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    checks = Q.checks_from_rows(both, [
        ("row_reconciliation", 50030, "fact", "rows", "staged"),
        *[("referential", 50036, k, f"lost_{k}", 0) for k in FACT_KEYS],
        *[("required_not_null", 50037, c, F.col("rows") - F.col(f"filled_{c}"), 0) for c in FACT_REQUIRED],
        ("fact_date_range", 50039, "fact", "outside", 0)])
    months = by_date.where(F.col("Year").isNotNull()).groupBy(
        F.col("Year").cast("int").alias("y"), F.col("Month").cast("int").alias("m")).agg(total(n).alias("fact_rows"))
    recon = staging_months.groupBy("y", "m").agg(total("n").alias("staging_rows")).join(months, ["y", "m"], "left")
    return checks.unionByName(Q.monthly_recon(recon.withColumnsRenamed({"y": "Year", "m": "Month"})))


def observed_rows(spark, staging_rows: int, fact_rows: int) -> DataFrame:
    """50022 from the row counts that the two writes reported; no table is read."""
    both = spark.createDataFrame([(fact_rows, staging_rows)], "f bigint, s bigint")
    return Q.check_frame(both, "row_reconciliation", 50022, F.lit("fact"), "f", "s")


def file_gates(report: DataFrame) -> DataFrame:
    """Checks on ``sources.files.file_report``, a row for each file and check.

    header_matches: missing, extra or reordered columns; file_terminated: the last line
    has its line end, so the copy is whole; file_fields: lines with another number of
    fields than the header declares.
    """
    bad = F.col("missing_columns") + F.col("extra_columns") + F.when(F.col("same_order"), 0).otherwise(1)
    return Q.checks_from_rows(report, [
        ("header_matches", None, F.col("file_name"), bad, 0),
        ("file_terminated", None, F.col("file_name"), F.col("terminated").cast("int"), 1),
        ("file_fields", None, F.col("file_name"), "odd_lines", 0)])


def file_rows(report: DataFrame, loaded: DataFrame) -> DataFrame:
    """Each file's rows in the loaded table against its lines without the header (K7).

    ``loaded``: (file_path, rows) of the parsed and stored rows.
    """
    both = report.select("file_path", "file_name", "lines").join(loaded, "file_path", "full_outer")
    return Q.check_frame(both.withColumn("file_name", F.coalesce("file_name", "file_path")), "file_rows", None, "file_name",
                         F.coalesce("rows", F.lit(0)), F.greatest(F.col("lines") - 1, F.lit(0)))
