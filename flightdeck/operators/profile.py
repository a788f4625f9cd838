"""Profiling operators: counts, null profiles, distinct values, histograms,
duration statistics, HHMM profiles, ordered string aggregation, value-set
comparison and stratified sampling.  Each profile over many columns is one
aggregation whose single row is unpivoted afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightdeck.operators.keys import join_same
from flightdeck.sinks.tables import store


def _unpivot_one(one: DataFrame, rows: list[Column]) -> DataFrame:
    return one.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: non-NULL and NULL counts (one pass)."""
    columns = columns or df.columns
    # count(col) per column plus one row count: the narrowest aggregate code
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"v{i}")
                                                 for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("non_null"),
                     (F.col("_rows") - F.col(f"v{i}")).alias("nulls")) for i, c in enumerate(columns)]
    return _unpivot_one(df.agg(*aggs), rows)


def nunique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct counts without and with NULL as a value (pandas ``nunique``)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count_distinct(F.col(c)).alias(f"d{i}"),
                 F.max(F.col(c).isNull().cast("int")).alias(f"z{i}")]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("nunique"),
                     (F.col(f"d{i}") + F.coalesce(F.col(f"z{i}"), F.lit(0))).cast("bigint")
                     .alias("nunique_with_null"))
            for i, c in enumerate(columns)]
    return _unpivot_one(df.agg(*aggs), rows)


def melt(df: DataFrame, columns: list[str], name: str = "column_name",
         value: str = "value") -> DataFrame:
    """Columns to (name, value) rows (values cast to string)."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value))
                      for c in columns])
    return df.select(F.inline(pairs))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL values per column; a partial distinct runs per task
    before the shuffle, so each task ships each value once."""
    return melt(df, columns).filter(F.col("value").isNotNull()).distinct()


def value_set_diff(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: values only before, only after, and whether the sets are equal."""
    b = distinct_values(before, columns).withColumn("_b", F.lit(1))
    a = distinct_values(after, columns).withColumn("_a", F.lit(1))
    j = b.join(a, ["column_name", "value"], "full_outer")
    return j.groupBy("column_name").agg(
        F.count_if(F.col("_a").isNull()).alias("only_before"),
        F.count_if(F.col("_b").isNull()).alias("only_after")).withColumn(
        "unchanged", (F.col("only_before") == 0) & (F.col("only_after") == 0))


def value_ranges(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """(column_name, value, _n, _range): rows per distinct non-NULL value, dealt by ranges.

    A partial count per task comes before the shuffle, so a hot value is one row; the
    counted values are stored before they are range-partitioned, so that sampling the
    bounds does not run ``df`` again.  Ranges ascend by column and value.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("_n"))
    by = [F.col("column_name"), F.col("value")]
    counts = store(counts, "value-counts")
    dealt = counts.repartitionByRange(partitions, *by) if partitions else counts.repartitionByRange(*by)
    return store(dealt.withColumn("_range", F.spark_partition_id()), "value-ranges")


def duration_profile(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Mean (2 dp) and exact median per column, NULL without a value.

    The median is found by selection: rows are counted per distinct value, the values
    dealt by ranges, the ranges' totals (one row a column and partition) added up, and
    only the ranges that hold a middle row are numbered.  No task sees more than one
    range of distinct values, however many there are.
    """
    ranges = value_ranges(df, columns, partitions)
    totals = ranges.groupBy("column_name", "_range").agg(
        F.sum("_n").alias("_in"), F.sum(F.col("value") * F.col("_n")).alias("_sum"))
    whole = Window.partitionBy("column_name")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column_name", "_range", "_in", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_off"),
                            F.sum("_in").over(whole).alias("_all"), F.sum("_sum").over(whole).alias("_total"))
    middles = F.array(*[F.floor((F.col("_all") - i) / 2) - F.col("_off") for i in (1, 0)])
    picks = offsets.withColumn("_at", F.explode(middles)).filter(
        (F.col("_at") >= 0) & (F.col("_at") < F.col("_in"))).drop("_in", "_off")
    # two rows a column at most, so the hint's side is bounded by the list of columns
    picks = F.broadcast(store(picks, "median-places"))
    inside = Window.partitionBy("column_name", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    place = ["column_name", "_range"]
    numbered = ranges.join(picks, place, "left_semi").withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    found = numbered.join(picks, place).filter(
        (F.col("_at") >= F.col("_first")) & (F.col("_at") < F.col("_first") + F.col("_n")))
    medians = found.groupBy("column_name").agg(F.avg("value").alias("median"), F.round(
        F.max("_total") / F.max("_all"), 2).alias("mean"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    return names.join(medians, "column_name", "left").select("column_name", "mean", "median")


def hhmm_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """HHMM range profile per column: min, max, and counts of 2400, > 2400,
    negative, and minutes above 59."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        v = F.col(c).cast("string").try_cast("double").try_cast("bigint")
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 F.count_if(v == 2400).alias(f"e{i}"), F.count_if(v > 2400).alias(f"o{i}"),
                 F.count_if(v < 0).alias(f"n{i}"), F.count_if(F.pmod(v, F.lit(100)) > 59).alias(f"b{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("min_value"),
                             F.col(f"hi{i}").alias("max_value"), F.col(f"e{i}").alias("n_2400"),
                             F.col(f"o{i}").alias("n_over_2400"), F.col(f"n{i}").alias("n_negative"),
                             F.col(f"b{i}").alias("n_bad_minutes")))
    return _unpivot_one(df.agg(*aggs), rows)


def ordered_listagg(df: DataFrame, by: list[str], value: str, order: str, sep: str = ",",
                    out: str = "value_list", distinct: bool = True) -> DataFrame:
    """``STRING_AGG(value, sep) WITHIN GROUP (ORDER BY order)`` per group.

    With ``distinct`` (the default) the (group, order, value) triples are
    de-duplicated first -- a partial aggregate before the shuffle -- so a
    group's list holds one entry per distinct value, not one per row, and a
    group holding a third of all rows still collects a bounded list.
    NULL values are skipped, as ``STRING_AGG`` does.
    """
    src = df.filter(F.col(value).isNotNull()).select(*by, F.col(order).alias("_o"),
                                                     F.col(value).alias("_v"))
    if distinct:
        src = src.distinct()
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"), F.col("_v").alias("v"))))
    return src.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda x: x["v"]), sep).alias(out))


def month_histogram(df: DataFrame, first_year: int, last_year: int,
                    date_col: str = "FL_DATE") -> DataFrame:
    """Rows per (year, month) of the period, months without rows shown as 0."""
    spark = df.sparkSession
    have = df.groupBy(F.year(date_col).alias("Year"), F.month(date_col).alias("Month")).agg(
        F.count(F.lit(1)).alias("n"))
    exp = (spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("Year"))
           .select("Year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month")))
    return exp.join(have, ["Year", "Month"], "left").select(
        "Year", "Month", F.coalesce("n", F.lit(0)).alias("row_count"))


def _below(rows: DataFrame, limits: DataFrame, strata: list[str]) -> DataFrame:
    """The rows whose ``_place`` is at most their stratum's ``_last``.

    A semi-join hands rows on as they are; an inner join would copy every wide row beside
    its limit before most of them are dropped.  NULL strata are strata.
    """
    named = limits.select(F.col("_last"), *[F.col(c).alias(f"_of_{c}") for c in strata])
    on = F.col("_place") <= F.col("_last")
    for c in strata:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(named, on, "left_semi")


def sample_candidates(df: DataFrame, strata: list[str], n: int, place: Column, slack: float = 6.0) -> DataFrame:
    """The rows of ``df`` with the least ``place`` (bigint, even over its range): at least
    ``min(n, stratum size)`` in each stratum and little more.

    Strata are counted; a stratum's threshold keeps the share of places that is expected
    to hold n rows plus ``slack`` standard deviations.  Strata that come out short are
    read again with four times the share, until none is: nothing is left to chance.
    NULL strata are strata.  ``place`` is kept as column ``_place``.
    """
    rows = df.withColumn("_place", place)
    want = F.least(F.lit(n), F.col("_size"))
    share = (want + slack * F.sqrt(want) + (10 if slack > 0 else 0)) / F.col("_size")
    limits = store(df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size"))
                   .select(*strata, "_size", F.greatest(share, F.lit(1.0) / F.col("_size")).alias("_share")), "sample-limits")
    done = None
    while True:
        last = F.when(F.col("_share") >= 1, F.lit((1 << 63) - 1)).otherwise(
            (F.col("_share") * float(1 << 64) - float(1 << 63)).cast("bigint"))
        kept = store(_below(rows, limits.select(*strata, last.alias("_last")), strata), "sample-kept")
        got = kept.groupBy(*strata).agg(F.count(F.lit(1)).alias("_got"))
        short = store(join_same(limits, got, strata, "left").filter(
            (F.coalesce("_got", F.lit(0)) < want) & (F.col("_share") < 1)).drop("_got"), "sample-short")
        again = not short.isEmpty()
        if again:
            kept = join_same(kept, short, strata, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        if not again:
            return done
        limits = short.withColumn("_share", F.col("_share") * 4)


def stratified_sample(df: DataFrame, strata: list[str], n: int, seed: int,
                      key: list[str], slack: float = 6.0) -> DataFrame:
    """Exactly ``min(n, stratum size)`` rows per stratum, chosen by a seeded hash: those
    with the least hash, ties by key.

    A threshold on the hash (:func:`sample_candidates`) leaves little more than ``n``
    rows a stratum before the ranking, whatever the number of tasks; ``row_number() <= n``
    then cuts them exactly.  ``key`` must be unique for a reproducible choice.
    """
    place = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
    w = Window.partitionBy(*strata).orderBy("_place", *[F.col(k) for k in key])
    kept = sample_candidates(df, strata, n, place, slack)
    return kept.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn", "_place")


def schema_report(df: DataFrame, declared_nullable: dict[str, bool] | None = None) -> DataFrame:
    """Catalogue + ``info()`` view of a table: per column its ordinal, name,
    type, nullability (the declared one when given), non-NULL count and the
    row count.  The counts are one aggregation over the table whose single
    row is unpivoted; the catalogue part comes from the schema."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    rows = []
    for i, f in enumerate(fields):
        aggs.append(F.count(F.col(f.name)).alias(f"v{i}"))
        nullable = f.nullable if declared_nullable is None else declared_nullable.get(f.name, True)
        rows.append(F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("data_type"),
                             F.lit(nullable).alias("nullable"),
                             F.col(f"v{i}").alias("non_null_count"), F.col("_rows").alias("row_count")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
