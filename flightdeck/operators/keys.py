"""Dense sequential surrogate keys without a single-partition window.

``row_number() over (order by ...)`` moves every row into one task.  Two ways to the
same numbers:

* :func:`numbered_by_group` (:func:`grouped_keys` stores its input first), for tables whose order starts with a date: count the rows of
  every date (of a large one, of its second column and pieces), add them up in key
  order, and number the rows inside each group.  Nothing is sampled or stored but the
  counts.
* :func:`sequential_keys`, for any order: the rows are range-partitioned on the
  (total) order, each partition is numbered locally, and a running offset per
  partition is added.  Range bounds come from a sample of the key, so a hot value of
  the leading column is still split across partitions by the trailing columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightdeck.sinks.tables import store

#: Rows of a date from which it is grouped by the second column, and of such a group
#: from which it is numbered in pieces.
GROUP_ROWS = 1_000_000


def _total_order(df: DataFrame, order: list[str]) -> list[str]:
    """Append every remaining column so the order is total (stable reruns)."""
    return list(order) + [c for c in df.columns if c not in order]


def sequential_keys(df: DataFrame, order: list[str], key_col: str,
                    start: int | Column = 0, partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start + 1, 2, ... following ``order`` (ascending).

    ``df`` is stored first, so that sampling the range bounds and sorting both read the
    stored rows and the plan under them runs once.  One range shuffle on the total
    order; inside each partition the rows are sorted and numbered by the low 33 bits of
    ``monotonically_increasing_id`` (the record index within the partition).  The
    numbered rows are stored too: the per-partition counts and the final rows read the
    same data.  Offsets are a running sum over one row per partition, broadcast back
    (bounded by the partition count).
    """
    rows = store(df, "rows-to-number")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = _total_order(rows, order)
    record_in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = store(rows.repartitionByRange(n, *full).sortWithinPartitions(*full)
                     .withColumn("_pid", F.spark_partition_id())
                     .withColumn("_rn", record_in_partition + 1), "numbered-rows")
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = numbered.join(F.broadcast(offsets), "_pid").withColumn(
        key_col, (start_col + F.col("_off") + F.col("_rn")).cast("bigint"))
    return out.drop("_pid", "_off", "_rn")


def join_same(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join on equal columns, NULL equal to NULL; the right side's copies go."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    return left.join(named, on, how).drop(*[f"_r_{c}" for c in columns])


def group_pieces(rows: DataFrame, group: list[str], spread: str, limit: int) -> DataFrame:
    """``rows`` with ``_piece``: groups over ``limit`` rows are cut along ``spread``.

    Pieces follow the order of ``spread`` (an integer column; NULL first), at equal
    steps between its least and greatest value in the group, so numbering piece after
    piece keeps the order.  Without a group over the limit no row is joined.
    """
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(spread).alias("_lo"), F.max(spread).alias("_hi"))
    big = store(sizes.where(F.col("_n") > limit), "big-groups")
    if big.isEmpty():
        return rows.withColumn("_piece", F.lit(0).cast("bigint"))
    step = F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.ceil(F.col("_n") / limit))
    piece = F.floor((F.col(spread) - F.col("_lo")) / step) + 1
    joined = join_same(rows, big, group, "left")
    return joined.withColumn("_piece", F.coalesce(piece, F.lit(0)).cast("bigint")).drop("_n", "_lo", "_hi")


def day_offsets(counts: DataFrame, day: str, group: list[str]) -> DataFrame:
    """Rows before each group: of earlier days (one row a day), then of earlier groups
    of the day."""
    earlier = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = counts.groupBy(day).agg(F.sum("_n").alias("_day")).select(
        day, F.coalesce(F.sum("_day").over(earlier), F.lit(0)).alias("_days"))
    within = Window.partitionBy(day).orderBy(*group[1:]).rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0))).drop("_n")
    return join_same(groups, days, [day], "inner").withColumn("_off", F.col("_days") + F.col("_within")).drop("_days", "_within")


def grouped_keys(df: DataFrame, order: list[str], key_col: str, limit: int = GROUP_ROWS) -> DataFrame:
    """:func:`numbered_by_group` of stored rows: ``df`` is run once, whatever it costs."""
    return numbered_by_group(store(df, "rows-to-number"), order, key_col, limit)


def numbered_by_group(df: DataFrame, order: list[str], key_col: str, limit: int = GROUP_ROWS) -> DataFrame:
    """Add ``key_col`` = 1, 2, ... following ``order`` (ascending), by group offsets.

    ``order`` starts with a date-like column, a second one, and an integer column along
    which large (first, second) groups are cut.  A day up to ``limit`` rows is one group;
    larger ones are grouped by the second column too.  ``df`` must give the same rows
    each time it runs: counting reads only its day (of larger days the second and third
    column), the rows are dealt and sorted once, and only where ``key_col`` is read --
    the offsets, one row a day unless days are large, are looked up after it.
    """
    day, second, spread = order[:3]
    days = store(df.groupBy(day).agg(F.count(F.lit(1)).alias("_n")), "day-counts")
    big = store(days.where(F.col("_n") > limit).select(day, F.lit(True).alias("_big")), "big-days")
    if big.isEmpty():
        rows, group = df, [day]
        counts = days
    else:
        second_of_big = F.when(F.col("_big"), F.col(second))
        rows = join_same(df, F.broadcast(big), [day], "left").withColumn("_second", second_of_big).drop("_big")
        rows = group_pieces(rows, [day, "_second"], spread, limit)
        group = [day, "_second", "_piece"]
        counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    offsets = store(day_offsets(store(counts, "group-counts"), day, group) if len(group) > 1
                    else day_offsets(days.withColumn("_one", F.lit(0)), day, [day, "_one"]).drop("_one"), "group-offsets")
    inside = Window.partitionBy(*group).orderBy(*_total_order(df, order)[1:])
    numbered = rows.withColumn("_rn", F.row_number().over(inside))
    keyed = join_same(numbered, offsets, group, "inner")
    return keyed.withColumn(key_col, (F.col("_off") + F.col("_rn")).cast("bigint")).select(*df.columns, key_col)
