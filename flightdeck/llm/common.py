"""Shared pieces: reading the tables, pinning intermediate results, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.session import scratch_path

#: Stands for a NULL doc_id inside packed arrays; NULL sorts first, as in Spark.
NULL_ID = -(1 << 63)


def give_back() -> None:
    """Return a Python worker's freed memory to the system.

    Workers wait between stages beside the executor's heap; what they keep for later
    allocations counts against the executor while other stages run.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a partition's batches, then :func:`give_back`."""
    def over(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()
    return over


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id BIGINT, text STRING): a NULL text becomes empty; other columns go."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pinned(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can reach, so a lost executor
    costs a re-read and an expensive step runs once for several consumers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """Total UTF-8 bytes of a text column, to size partition counts."""
    return docs.select(F.sum(F.octet_length(F.col(col))).alias("b")).first()["b"] or 0


def parts_for(total: int, per_part: int, least: int = 64) -> int:
    """Number of hash partitions so that each holds about ``per_part`` units."""
    return max(least, -(-total // per_part))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that ``edges`` connect a node to.

    Alternating large-star and small-star contraction; every round is a
    minimum per node (combined before the shuffle) and one join, written to the
    shared folder.  Rounds grow with the logarithm of the longest chain.  Only
    nodes that have an edge are returned; NULL ends and self-loops are ignored.
    """
    def both(e):
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def signature(e):
        r = e.agg(F.count(F.lit(1)).alias("n"),
                  F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return r["n"], r["x"]

    e = pinned(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .where(F.col("u") > F.col("v")).distinct(), "cc")
    seen = signature(e)
    while seen[0]:
        near = both(e)
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (near.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = pinned(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v")))
                   .where("u <> v").distinct(), "cc")
        now = signature(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
