"""Text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightdeck.functions._util import as_col
from flightdeck.schemas import PANDAS_MISSING_TOKENS

# Fixed value: separator of a route label (U+2192 with spaces).
ROUTE_SEPARATOR = " → "


def nullif_tokens(c: Column | str, tokens: Iterable[str] = PANDAS_MISSING_TOKENS) -> Column:
    """Turn the text tokens a pandas reader treats as missing into NULL."""
    c = as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def route_label(origin_code: Column | str, dest_code: Column | str) -> Column:
    """``ORIG → DEST``; a missing code concatenates as empty text."""
    return F.concat(F.coalesce(as_col(origin_code), F.lit("")), F.lit(ROUTE_SEPARATOR),
                    F.coalesce(as_col(dest_code), F.lit("")))
