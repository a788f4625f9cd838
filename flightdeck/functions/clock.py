"""HHMM clock numbers -> ``HH:MM`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightdeck.functions._util import as_col
from flightdeck.schemas import INVALID_CLOCK


def hhmm_number(c: Column | str) -> Column:
    """HHMM text or number -> whole BIGINT (fraction truncated), NULL when not numeric."""
    return as_col(c).cast("string").try_cast("double").try_cast("bigint")


def hhmm_from_number(raw: Column | str, v: Column | str) -> Column:
    """``HH:MM`` from the raw value and its truncated number ``v``.

    Split from :func:`hhmm_to_time` so a caller converting many columns can
    compute ``v`` once in an earlier projection.
    """
    raw, v = as_col(raw), as_col(v)
    hours = F.floor(v / F.lit(100))
    minutes = v % F.lit(100)
    text = F.concat(F.lpad(hours.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(minutes.cast("string"), 2, "0"))
    return (F.when(raw.isNull(), F.lit(None).cast("string"))
            .when(v.isNull(), F.lit(INVALID_CLOCK))
            .when(v == 2400, F.lit("00:00"))
            .when((v < 0) | (hours > 23) | (minutes > 59), F.lit(INVALID_CLOCK))
            .otherwise(text))


def hhmm_to_time(c: Column | str) -> Column:
    """Convert an HHMM clock number (or its text) to ``HH:MM``.

    NULL stays NULL; a fractional value is truncated first (530.7 -> 05:30);
    2400 is end-of-day midnight and becomes ``00:00`` (so 0 and 2400 collide);
    negative values, hours above 23 or minutes above 59 become ``INVALID``,
    as does text that is not a number.  Pure Catalyst expression.
    """
    raw = as_col(c)
    return hhmm_from_number(raw, hhmm_number(raw))


def is_invalid_clock(c: Column | str) -> Column:
    return F.coalesce(as_col(c) == F.lit(INVALID_CLOCK), F.lit(False))
