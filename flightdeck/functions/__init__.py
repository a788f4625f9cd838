"""Pure column expressions (``Column -> Column``).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python UDF is used anywhere in the engine.
"""

from flightdeck.functions.clock import hhmm_to_time, is_invalid_clock
from flightdeck.functions.dates import (
    date_key, date_names, date_parts, iso_date_text, iso_weekday, is_weekend,
    parse_flight_date, year_month_key,
)
from flightdeck.functions.numeric import (
    bit_cast, is_fractional, is_non_numeric, safe_divide, strict_integer, zero_pad,
)
from flightdeck.functions.text import nullif_tokens, route_label

__all__ = [
    "hhmm_to_time", "is_invalid_clock", "date_key", "date_names", "date_parts",
    "iso_date_text", "iso_weekday", "is_weekend", "parse_flight_date", "year_month_key",
    "bit_cast", "is_fractional", "is_non_numeric", "safe_divide", "strict_integer",
    "zero_pad", "nullif_tokens", "route_label",
]
