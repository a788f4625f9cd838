"""Raw monthly text -> typed staging rows, plus a one-pass conversion report.

Conversion rules per column kind (schemas.STAGING_COLUMNS):

* every column: text tokens a pandas reader treats as missing become NULL;
* ``clock``: HHMM number -> ``HH:MM`` (``functions.hhmm_to_time``);
* ``date``: ``M/d/yyyy h:mm:ss a`` text -> DATE, unparseable -> NULL;
* ``int``: numeric text -> SMALLINT / INT, BIT columns -> BOOLEAN;
  non-numeric or fractional values -> NULL;
* ``text``: unchanged.

The conversion is a single projection (no shuffle).  The report evaluates
every counter of every column in one aggregation over the raw rows, then
unpivots the one result row into one row per column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck.functions import (
    hhmm_to_time, is_fractional, is_invalid_clock, is_non_numeric, nullif_tokens,
    parse_flight_date, strict_integer,
)
from flightdeck.functions.clock import hhmm_from_number, hhmm_number
from flightdeck.functions.numeric import integer_from_number
from flightdeck.schemas import PANDAS_MISSING_TOKENS, STAGING_COLUMNS, StagingColumn


def _target_type(col: StagingColumn) -> str:
    if col.sql_type in ("SMALLINT", "TINYINT"):
        return "short"
    return "int"


def convert_column(col: StagingColumn, src: Column) -> Column:
    if col.kind == "clock":
        return hhmm_to_time(src)
    if col.kind == "date":
        return parse_flight_date(src)
    if col.kind == "int":
        if col.sql_type == "BIT":
            return strict_integer(src, "int").cast("boolean")
        return strict_integer(src, _target_type(col))
    return src


def _parsed(raw: DataFrame, tokens: tuple[str, ...],
            columns: tuple[StagingColumn, ...]) -> DataFrame:
    """First projection: token-cleaned text ``_s<i>`` and, for numeric kinds,
    the parsed number ``_n<i>``, each evaluated once per row.  The second
    projection reads these columns (Catalyst does not re-inline an expensive
    expression that is referenced several times)."""
    cols = []
    for i, c in enumerate(columns):
        src = nullif_tokens(F.col(c.name), tokens)
        cols.append(src.alias(f"_s{i}"))
        if c.kind == "clock":
            cols.append(hhmm_number(src).alias(f"_n{i}"))
        elif c.kind == "int":
            cols.append(src.try_cast("double").alias(f"_n{i}"))
    known = {c.name for c in columns}
    return raw.select(*cols, *[F.col(n) for n in raw.columns if n not in known])


def _converted(c: StagingColumn, i: int) -> Column:
    s, n = F.col(f"_s{i}"), F.col(f"_n{i}")
    if c.kind == "clock":
        return hhmm_from_number(s, n)
    if c.kind == "date":
        return parse_flight_date(s)
    if c.kind == "int":
        if c.sql_type == "BIT":
            return integer_from_number(n, "int").cast("boolean")
        return integer_from_number(n, _target_type(c))
    return s


def clean(raw: DataFrame, tokens: Iterable[str] = PANDAS_MISSING_TOKENS,
          columns: tuple[StagingColumn, ...] = STAGING_COLUMNS) -> DataFrame:
    """Typed staging frame; columns not in the layout pass through unchanged.

    Same result as applying :func:`convert_column` to every column, laid out
    as two projections so every value is parsed once.
    """
    tokens = tuple(tokens)
    known = {c.name for c in columns}
    parsed = _parsed(raw, tokens, columns)
    exprs = [_converted(c, i).alias(c.name) for i, c in enumerate(columns)]
    extra = [F.col(n) for n in raw.columns if n not in known]
    return parsed.select(*exprs, *extra)


REPORT_FIELDS = ("raw_nulls", "converted_nulls", "invalid_clock", "non_numeric", "fractional",
                 "unparsed_dates")


def conversion_report(raw: DataFrame, staging: DataFrame | None = None,
                      tokens: Iterable[str] = PANDAS_MISSING_TOKENS,
                      columns: tuple[StagingColumn, ...] = STAGING_COLUMNS) -> DataFrame:
    """One row per column: ``column_name, kind`` + the counters in REPORT_FIELDS.

    Counted on both sides of the conversion, as the gates compare them:

    * raw side (one aggregation over the token-cleaned, parsed text): NULLs,
      non-numeric and fractional values;
    * converted side (one aggregation over ``staging``, by default
      ``clean(raw)``): NULLs and ``INVALID`` clocks.

    A non-NULL date that does not parse is the only way a date becomes NULL,
    so ``unparsed_dates = converted_nulls - raw_nulls`` for the date column.
    The two single-row results are unpivoted and joined on the column name
    (62 rows per side).  Counters that do not apply to a kind are 0.
    """
    tokens = tuple(tokens)
    if staging is None:
        staging = clean(raw, tokens, columns)
    parsed = _parsed(raw, tokens, columns)
    raw_aggs = [F.count(F.lit(1)).alias("_rows")]
    conv_aggs = [F.count(F.lit(1)).alias("_rows")]
    raw_rows, conv_rows = [], []
    zero = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        src, num = F.col(f"_s{i}"), F.col(f"_n{i}")
        # NULL counts as row count minus count(col): the narrowest aggregate code
        raw_aggs.append(F.count(src).alias(f"rv{i}"))
        if c.kind == "int":
            raw_aggs.append(F.count(num).alias(f"nv{i}"))
            raw_aggs.append(F.count_if(num != F.floor(num)).alias(f"fr{i}"))
        raw_rows.append(F.struct(
            F.lit(c.name).alias("column_name"), F.lit(c.kind).alias("kind"),
            (F.col("_rows") - F.col(f"rv{i}")).alias("raw_nulls"),
            # a present value whose number is NULL is non-numeric
            ((F.col(f"rv{i}") - F.col(f"nv{i}")) if c.kind == "int" else zero).alias("non_numeric"),
            (F.col(f"fr{i}") if c.kind == "int" else zero).alias("fractional")))
        conv = F.col(c.name)
        conv_aggs.append(F.count(conv).alias(f"cv{i}"))
        if c.kind == "clock":
            conv_aggs.append(F.count_if(is_invalid_clock(conv)).alias(f"iv{i}"))
        conv_rows.append(F.struct(
            F.lit(c.name).alias("column_name"),
            (F.col("_rows") - F.col(f"cv{i}")).alias("converted_nulls"),
            (F.col(f"iv{i}") if c.kind == "clock" else zero).alias("invalid_clock")))
    raw_side = parsed.agg(*raw_aggs).select(F.inline(F.array(*raw_rows)))
    conv_side = staging.agg(*conv_aggs).select(F.inline(F.array(*conv_rows)))
    j = raw_side.join(F.broadcast(conv_side), "column_name")
    unparsed = F.when(F.col("kind") == "date", F.col("converted_nulls") - F.col("raw_nulls")
                      ).otherwise(zero)
    return j.select("column_name", "kind", "raw_nulls", "converted_nulls", "invalid_clock",
                    "non_numeric", "fractional", unparsed.cast("bigint").alias("unparsed_dates"))


def missing_token_profile(raw: DataFrame, tokens: Iterable[str] = PANDAS_MISSING_TOKENS,
                          columns: tuple[StagingColumn, ...] = STAGING_COLUMNS) -> DataFrame:
    """Per column: NULLs as read, token values that mean "missing", NULLs after
    token handling.  One aggregation."""
    tokens = list(tokens)
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        v = F.col(c.name)
        aggs += [F.count(v).alias(f"v{i}"), F.count_if(v.isin(tokens)).alias(f"t{i}")]
        nulls = F.col("_rows") - F.col(f"v{i}")
        rows.append(F.struct(F.lit(c.name).alias("column_name"), nulls.alias("raw_nulls"),
                             F.col(f"t{i}").alias("token_values"),
                             (nulls + F.col(f"t{i}")).alias("nulls_after")))
    return raw.agg(*aggs).select(F.inline(F.array(*rows)))


def conversion_checks(report: DataFrame) -> DataFrame:
    """Gates on a :func:`conversion_report`: INVALID clocks, NULL counts kept,
    and no unparseable / non-numeric / fractional values.  One pass over the
    report rows; each row yields the checks that apply to its kind."""
    kind = F.col("kind")
    rows = report.select("*", F.array(
        F.struct(F.lit("clock_valid").alias("_c"), (kind == "clock").alias("_a"),
                 F.col("invalid_clock").alias("_o"), F.lit(0).cast("bigint").alias("_e")),
        F.struct(F.lit("null_preserved").alias("_c"), kind.isin("clock", "date", "int").alias("_a"),
                 F.col("converted_nulls").alias("_o"), F.col("raw_nulls").alias("_e")),
        F.struct(F.lit("conversion_failures").alias("_c"), kind.isin("date", "int").alias("_a"),
                 (F.col("non_numeric") + F.col("fractional") + F.col("unparsed_dates")).alias("_o"),
                 F.lit(0).cast("bigint").alias("_e"))).alias("_checks"))
    flat = rows.select("column_name", F.inline("_checks")).filter(F.col("_a"))
    return flat.select(F.col("_c").alias("check"), F.lit(None).cast("int").alias("code"),
                       F.col("column_name").alias("subject"), F.col("_o").cast("bigint").alias("observed"),
                       F.col("_e").cast("bigint").alias("expected"),
                       F.coalesce(F.col("_o").eqNullSafe(F.col("_e")), F.lit(False)).alias("passed"))
