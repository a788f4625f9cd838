"""Strict integer conversion, flags, padding and safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightdeck.functions._util import as_col


def _numeric(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def is_non_numeric(c: Column | str) -> Column:
    """Present value that is not a number (conversion failure)."""
    c = as_col(c)
    return c.isNotNull() & _numeric(c).isNull()


def is_fractional(c: Column | str) -> Column:
    """Numeric value with a fractional part (``7.5``); ``7.0`` is integral."""
    n = _numeric(as_col(c))
    return F.coalesce(n != F.floor(n), F.lit(False))


def strict_integer(c: Column | str, to_type: str = "int") -> Column:
    """Numeric text -> nullable integer of ``to_type``.

    ``'7'`` and ``'7.0'`` give 7, blank/NULL gives NULL.  Non-numeric and
    fractional inputs give NULL too; gates count them with
    :func:`is_non_numeric` / :func:`is_fractional` before the value is used.
    """
    n = _numeric(as_col(c))
    return F.when(n == F.floor(n), n.try_cast(to_type))


def integer_from_number(n: Column | str, to_type: str = "int") -> Column:
    """Integral DOUBLE -> ``to_type``; fractional or out-of-range -> NULL.
    (``strict_integer`` on an already parsed number.)"""
    n = as_col(n)
    return F.when(n == F.floor(n), n.try_cast(to_type))


def bit_cast(c: Column | str) -> Column:
    """0/1 (or any number) -> BOOLEAN keeping NULL; nonzero is true."""
    return as_col(c).cast("boolean")


def zero_pad(c: Column | str, width: int = 2) -> Column:
    return F.lpad(as_col(c).cast("string"), width, "0")


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL (not an error) for a zero or NULL denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))
