"""Shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: an
offset and a step, both from its name, walk all slots.  Shards take turns; on its
turn a shard claims its first slot that is still free.  Each shard so owns size/N
slots, give or take one, and removing a shard moves little but its own slots.  A
key's shard is the owner of the slot that its hash names: one broadcast lookup.

The table has ``size`` rows whatever the data, so it is always broadcast.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production parameters: shards and slots (prime, over 100 slots a shard).
SHARDS, SLOTS = 32, 4093


def key_hash(key: Column) -> Column:
    """The first 32 bits of the MD5 of a key's text, as BIGINT; NULL is the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, names: list[str], size: int = SLOTS) -> DataFrame:
    """(slot BIGINT, shard STRING): ``size`` rows; ``size`` must be a prime.

    With rank(slot) = (slot - offset) * factor mod size, a shard's preference order
    is by rank; ``factor`` is the inverse of its step.
    """
    if not 0 < len(set(names)) == len(names) <= size:
        raise ValueError("needs distinct shard names, at most one a slot")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime")
    shards = F.array(*[F.lit(n) for n in names])
    offsets = F.transform(shards, lambda n: key_hash(F.concat(n, F.lit(":offset"))) % size)
    factors = F.transform(shards, lambda n: key_hash(F.concat(n, F.lit(":step"))) % (size - 1) + 1)

    def turn(state, t):
        shard = (t % len(names)).cast("int")
        offset, factor = F.get(state["offset"], shard), F.get(state["factor"], shard)
        ranked = F.transform(state["free"], lambda s: F.pmod((s - offset) * factor, F.lit(size)) * size + s)
        # a one-element array binds the claim, so that it is found once a turn
        claim = F.array(F.array_min(ranked) % size)
        return F.get(F.transform(claim, lambda c: F.struct(
            F.filter(state["free"], lambda s: s != c).alias("free"),
            F.concat(state["claims"], F.array(c)).alias("claims"),
            state["offset"].alias("offset"), state["factor"].alias("factor"))), F.lit(0))

    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint"))
    # the state carries the preferences: each is worked out once, not once a slot
    start = F.struct(slots.alias("free"), F.array().cast("array<bigint>").alias("claims"),
                     offsets.alias("offset"), factors.alias("factor"))
    filled = spark.range(1).select(shards.alias("names"), F.aggregate(slots, start, turn, lambda s: s["claims"]).alias("claims"))
    return (filled.select("names", F.posexplode("claims").alias("t", "slot"))
            .select("slot", F.get("names", F.col("t") % len(names)).alias("shard")))


def placed(df: DataFrame, key: str, names: list[str], size: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; rows with equal keys share a shard.

    A NULL key is placed as the empty text; columns named slot or shard are
    replaced; an empty table stays empty.
    """
    table = lookup_table(df.sparkSession, names, size)
    rows = df.drop("slot", "shard").withColumn("slot", key_hash(F.col(key)) % size)
    return rows.join(F.broadcast(table), "slot", "left")


def op6_permutation_table_sharding(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    names = [f"shard-{i}" for i in range(SHARDS)]
    return placed(documents(spark, sf_dir).select("doc_id"), "doc_id", names).select("doc_id", "slot", "shard")


_HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"

ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, {_HASH.format("'shard-' || i || ':offset'")} % {SLOTS} AS first,
         {_HASH.format("'shard-' || i || ':step'")} % {SLOTS - 1} + 1 AS factor
  FROM range({SHARDS}) r(i)),
filling AS (
  SELECT 0::BIGINT AS t, range({SLOTS}) AS free, (-1)::BIGINT AS slot
  UNION ALL
  SELECT t + 1, list_filter(free, lambda s: s <> claim), claim
  FROM (SELECT t, free, list_min(list_transform(free, lambda s:
            (((s - first) * factor) % {SLOTS} + {SLOTS}) % {SLOTS} * {SLOTS} + s)) % {SLOTS} AS claim
        FROM filling JOIN shards ON i = t % {SHARDS} WHERE t < {SLOTS}) q),
owners AS (SELECT slot, 'shard-' || ((t - 1) % {SHARDS}) AS shard FROM filling WHERE t > 0),
keyed AS (SELECT doc_id, {_HASH.format("coalesce(doc_id::VARCHAR, '')")} % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, shard FROM keyed JOIN owners USING (slot)
"""
