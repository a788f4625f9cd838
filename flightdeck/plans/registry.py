"""Query catalogue: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightdeck.session import compile_in_parts

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def _compiled_in_parts(fn: Builder) -> Builder:
    @wraps(fn)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        compile_in_parts(spark)
        return fn(spark, sf_dir)
    return build


def query(name: str, sql: str | None = None):
    """Register a catalogue query and, when SQL-expressible, its oracle."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = _compiled_in_parts(fn)
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round6(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to 6 places (presentation + stable compare)."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def load_all() -> None:
    """Import every catalogue module so its queries register."""
    from flightdeck.plans import (  # noqa: F401
        q_dims, q_fact, q_functions, q_profile, q_quality, q_report, q_sources,
    )
