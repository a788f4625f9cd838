"""Conversation prefix trie by bursting: heads, suffix containers, a sorted sweep.

Every distinct conversation is one row: the 16-byte digests of its turns in order (its
path) and the words of each turn.  A container holds the conversations that agree up
to some turn.  While a container of several conversations holds more than ``limit``
remaining turns it bursts: the turns that all of its members share become trie heads,
and its members move, by their next turn, into new containers.  The containers that
remain are dealt to shards by digest, sorted by path, and swept once: a stack of open
nodes gives every node its members, children, leaves and savings.  Sums below heads
flow back from the last burst to the first.

Bursting never gathers a container: sizes are counts combined before the shuffle, and
members change containers row by row, so a first turn that a third of all
conversations share spreads over as many shards as it has continuations.  Copies of a
whole conversation are one row with a count.  Heads number at most turns / limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightdeck.llm.common import pinned

#: Bytes of a turn's digest in a path.
WIDTH = 16
#: Remaining turns from which a container of several conversations bursts.
LIMIT = 1024
#: A conversation starts with turns of the first one of its block of so many ids.
BLOCK = 20
#: Digits rendered into one row of a member list.
CHUNK = 1 << 16

ROOT = b""
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, WORD_SPLIT), ""))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words): every conversation with its block's opening turns.

    The first crc32(conv_id) % 4 turns come from the block's first conversation where
    there is one, the rest are its own after as many.  A NULL role or text is empty;
    a NULL turn sorts first and equal turns by their digest, so the order is total;
    repeated rows are turns of their own.  Rows without a conv_id belong to no
    conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = (conversations.where(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.struct(F.col("turn"), digest.alias("digest"), n_words(text).alias("words")).alias("t")))
    own = pinned(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
                 .select("conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words")), "trie-own")
    opening = (own.where(F.col("conv_id") % BLOCK == 0)
               .select(F.col("conv_id").alias("opens"), F.slice("digests", 1, 3).alias("open_digests"),
                       F.slice("words", 1, 3).alias("open_words")))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")

    def joined(theirs: str, ours: str, kind: str) -> Column:
        head = F.slice(F.coalesce(theirs, F.array().cast(f"array<{kind}>")), F.lit(1), F.col("taken"))
        return F.concat(head, F.slice(ours, F.col("taken") + 1, F.greatest(F.size(ours), F.lit(1))))
    return (own.withColumn("opens", F.col("conv_id") - F.col("conv_id") % BLOCK).join(opening, "opens", "left")
            .withColumn("taken", taken)
            .select("conv_id", F.unhex(F.array_join(joined("open_digests", "digests", "string"), "")).alias("path"),
                    joined("open_words", "words", "int").alias("words")))


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids sorted by (seq, conv_id) -> rows (seq, first, ids as text)."""
    schema = pa.schema([("seq", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        rows, size = [], 0
        for seq, conv in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            size = size + 1 if rows and rows[-1][0] == seq else 0
            if size % CHUNK == 0:
                rows.append((seq, conv, []))
            rows[-1][2].append(str(conv))
        yield pa.RecordBatch.from_pylist([{"seq": s, "first": f, "ids": ",".join(i)} for s, f, i in rows], schema=schema)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (seq, first) -> (seq, ends): one running hash, no list is held."""
    schema = pa.schema([("seq", pa.binary()), ("ends", pa.string())])
    now, seen = None, None
    for batch in batches:
        done = []
        for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if seq != now:
                if now is not None:
                    done.append({"seq": now, "ends": seen.hexdigest()})
                now, seen = seq, hashlib.sha256(ids.encode())
            else:
                seen.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"seq": now, "ends": seen.hexdigest()}], schema=schema)


def sequences(convs: DataFrame) -> DataFrame:
    """(path, words, n, conv, ends): distinct conversations, their copies and members' hash.

    Member ids are sorted and written out by ranges of (path, conv_id), which split the
    copies of one conversation over tasks; only the hash itself runs over them in turn.
    """
    marked = convs.withColumn("seq", F.unhex(F.md5("path")))
    ids = (marked.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
           .mapInArrow(_rendered, "seq binary, first bigint, ids string"))
    ends = ids.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_chained, "seq binary, ends string")
    one = marked.groupBy("seq").agg(F.first("path").alias("path"), F.first("words").alias("words"),
                                    F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    return one.join(ends, "seq").drop("seq")


def _turns(path: str = "path") -> Column:
    return (F.octet_length(path) / WIDTH).cast("int")


def _key(path: str, turns: Column) -> Column:
    """Digest of a path's first turns: the name of a container."""
    return F.unhex(F.md5(F.substring(F.col(path), F.lit(1), turns * WIDTH)))


def _shared_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of turns that a container's first and last path share."""
    for batch in batches:
        upto = []
        for low, high in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True):
            k = 0
            while k < len(low) and low[k:k + WIDTH] == high[k:k + WIDTH]:
                k += WIDTH
            upto.append(k // WIDTH)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto, pa.int32())], names=[*batch.schema.names, "upto"])


def burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(heads of each round, containers left): ``rows`` split until all are small.

    A row is a member (path, words, n, conv, ends) of container ``key``, whose members
    agree on ``at`` turns and hang below the head ``up`` with least member ``up_conv``.
    A container of one conversation never bursts: it has no other continuation.
    """
    heads, kept = [], []
    while True:
        size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum(_turns() - F.col("at") + 1).alias("t"))
        big = pinned(size.where((F.col("c") > 1) & (F.col("t") > limit)).select("key"), "trie-bursting")
        if big.isEmpty():
            return heads, [*kept, rows]
        kept.append(rows.join(big, "key", "left_anti"))
        members = rows.join(big, "key", "left_semi")
        found = members.groupBy("key").agg(
            F.first("up").alias("up"), F.first("up_conv").alias("up_conv"), F.first("at").alias("at"),
            F.sum("n").alias("n"), F.min("conv").alias("conv"), F.min("path").alias("low"), F.max("path").alias("high"),
            F.min_by("words", "path").alias("words"), F.min_by("ends", "path").alias("ends"))
        found = found.mapInArrow(_shared_turns, f"{_ddl(found)}, upto int")
        # the conversation that ends where the container parts sorts first
        found = pinned(found.select(
            "key", "up", "up_conv", "at", "upto", "n", "conv", F.slice("words", F.col("at"), F.col("upto") - F.col("at") + 1).alias("words"),
            F.when(_turns("low") == F.col("upto"), F.col("ends")).alias("ends")), "trie-heads")
        heads.append(found)
        below = found.select("key", "upto", F.col("conv").alias("head_conv"))
        rows = pinned(members.join(below, "key").where(_turns() > F.col("upto")).select(
            "path", "words", "n", "conv", "ends", _key("path", F.col("upto") + 1).alias("key"),
            (F.col("upto") + 1).alias("at"), F.col("key").alias("up"), F.col("head_conv").alias("up_conv")), "trie-members")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


class _Node:
    """An open node of the sweep; closed children wait for its least member."""

    __slots__ = ("children", "conv", "ends", "leaves", "n", "saved", "waiting", "words")

    def __init__(self, words: int):
        self.words, self.conv, self.ends = words, None, None
        self.n = self.children = self.leaves = self.saved = 0
        self.waiting: list[tuple] = []

    def meet(self, conv: int):
        self.conv = conv if self.conv is None else min(self.conv, conv)


class _Sweep:
    """Containers in order, members in path order: nodes leave when they close."""

    def __init__(self):
        self.open: list[_Node] = []
        self.out: list[tuple] = []
        self.key, self.path, self.at, self.up, self.up_conv = None, b"", 1, None, None

    def close(self, turns: int):
        """Close the open nodes deeper than ``turns``."""
        while self.open and self.at + len(self.open) - 1 > turns:
            depth = self.at + len(self.open) - 1
            node = self.open.pop()
            leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.words
            self.out.extend((*row, node.conv, None) for row in node.waiting)
            row = (node.conv, depth, node.n, node.children, leaves, saved, node.ends)
            if self.open:
                above = self.open[-1]
                above.meet(node.conv)
                above.n += node.n
                above.children += 1
                above.leaves += leaves
                above.saved += saved
                above.waiting.append(row)
            else:
                self.out.append((*row, self.up_conv, self.up))

    def add(self, key, at, up, up_conv, path, words, n, conv, ends):
        if key != self.key:
            self.close(-1)
            self.key, self.at, self.up, self.up_conv, shared = key, at, up, up_conv, at - 1
        else:
            shared, most = at - 1, min(len(path), len(self.path)) // WIDTH
            while shared < most and path[shared * WIDTH:(shared + 1) * WIDTH] == self.path[shared * WIDTH:(shared + 1) * WIDTH]:
                shared += 1
            self.close(shared)
        self.open.extend(_Node(w) for w in words[shared:])
        self.path = path
        last = self.open[-1]
        last.meet(conv)
        last.n += n
        last.ends = ends

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "parent_conv_id", "up")
        kinds = [pa.int64()] * 6 + [pa.string(), pa.int64(), pa.binary()]
        cols = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=list(names))


SWEPT = ("conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
         "ends string, parent_conv_id bigint, up binary")


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = _Sweep()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "at", "up", "up_conv", "path", "words", "n", "conv", "ends")]
        for row in zip(*columns, strict=True):
            sweep.add(*row)
            if len(sweep.out) > 20_000:
                yield sweep.take()
    sweep.close(-1)
    yield sweep.take()


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (its parent's; NULL at the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Reads conv_id, turn,
    role and text; see ``rebuilt`` for NULLs, ties and repeated rows.  A conversation
    left without turns is a member of the root alone.  Without any conversation there
    is no node.  A conversation is held as 20 bytes a turn in one row.
    """
    spark = conversations.sparkSession
    distinct = pinned(sequences(pinned(rebuilt(conversations), "trie-convs")), "trie-sequences")
    whole = distinct.agg(F.sum("n").alias("n"), F.min("conv").alias("conv"),
                         F.max(F.when(_turns() == 0, F.col("ends"))).alias("ends")).first()
    if whole["n"] is None:
        return spark.createDataFrame([], NODE)
    first = distinct.where(_turns() > 0).select(
        "path", "words", "n", "conv", "ends", _key("path", F.lit(1)).alias("key"), F.lit(1).alias("at"),
        F.lit(ROOT).alias("up"), F.lit(whole["conv"]).cast("long").alias("up_conv"))
    heads, left = burst(first, limit)
    rows = left[0]
    for more in left[1:]:
        rows = rows.unionByName(more)
    nodes = pinned(rows.repartition("key").sortWithinPartitions("key", "path")
                   .select("key", "at", "up", "up_conv", "path", "words", "n", "conv", "ends").mapInArrow(_swept, SWEPT),
                   "trie-nodes")
    tops = nodes.where(F.col("up").isNotNull()).select("up", "n_leaves", "saved_tokens")
    out = nodes.drop("up")
    for round_ in reversed(heads):
        below = tops.groupBy(F.col("up").alias("key")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        done = pinned(round_.join(below, "key"), "trie-summed")
        own = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
        tops = tops.unionByName(done.select("up", "n_leaves", (F.col("saved") + (F.col("n") - 1) * own).alias("saved_tokens")))
        out = out.unionByName(_chain(done))
    top = tops.where(F.col("up") == F.lit(ROOT)).agg(
        F.count(F.lit(1)).alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    root = top.select(F.lit(whole["conv"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                      F.lit(whole["n"]).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
                      F.lit(whole["ends"]).cast("string").alias("ends"), F.lit(None).cast("long").alias("parent_conv_id"))
    nobody = hashlib.sha256(b"").hexdigest()
    return out.unionByName(root).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nobody)).alias("ends_sha256"))


def _chain(done: DataFrame) -> DataFrame:
    """The nodes of each burst container's shared turns, from its first to its parting."""
    each = done.select("*", F.posexplode("words").alias("pos", "w"),
                       F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w).alias("total"))
    # words of this turn and the later shared ones
    before = F.coalesce(F.sum("w").over(Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.col("pos") == F.col("upto") - F.col("at")
    return each.select(
        F.col("conv").alias("conv_id"), (F.col("at") + F.col("pos")).cast("long").alias("depth"), F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n") - 1) * (F.col("total") - before)).alias("saved_tokens"),
        F.when(last, F.col("ends")).alias("ends"),
        F.when(F.col("pos") == 0, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _nibble(k: int) -> int:
    for _ in range(4):
        k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
    return k


ORACLE = f"""
WITH RECURSIVE crc(c, s, j, v) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT)
  FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, s, j + 1,
         xor(CAST({[_nibble(k) for k in range(16)]}[(xor(v, (ascii(s[j // 2 + 1]) >> (4 * (j % 2))) & 15) & 15) + 1] AS BIGINT), v >> 4)
  FROM crc WHERE j < 2 * length(s)
), convs AS (
  SELECT c, c - c % 20 AS base, xor(v, 4294967295) % 4 AS h FROM crc WHERE j = 2 * length(s)
), turns AS (
  SELECT c, digest, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS r
  FROM (SELECT conv_id AS c, turn, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
        FROM conversations WHERE conv_id IS NOT NULL)
), counts AS (
  SELECT c, count(*) AS n FROM turns GROUP BY c
), rebuilt AS (
  SELECT v.c, t.r AS d, digest, words FROM convs v JOIN turns t ON t.c = v.base AND t.r <= v.h
  UNION ALL
  SELECT v.c, least(coalesce(b.n, 0), v.h) + t.r - v.h, digest, words
  FROM convs v JOIN turns t ON t.c = v.c AND t.r > v.h LEFT JOIN counts b ON b.c = v.base
), prefixes AS (
  SELECT c, d, words, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, d, any_value(words) AS words, min(c) AS conv, count(*) AS n,
         CASE WHEN d > 0 THEN left(path, CAST(32 * (d - 1) AS INTEGER)) END AS parent
  FROM prefixes GROUP BY path, d
), children AS (
  SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), closure AS (
  SELECT DISTINCT a.path AS top, b.path AS path FROM prefixes a JOIN prefixes b ON a.c = b.c AND a.d <= b.d
), sums AS (
  SELECT top, sum((n.n - 1) * n.words) AS saved, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM closure JOIN nodes n ON n.path = closure.path LEFT JOIN children k ON k.parent = n.path GROUP BY top
), ends AS (
  SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS hash
  FROM (SELECT c, path, d, max(d) OVER (PARTITION BY c) AS deepest FROM prefixes) WHERE d = deepest GROUP BY path
)
SELECT n.conv AS conv_id, CAST(n.d AS BIGINT) AS depth, p.conv AS parent_conv_id, n.n AS n_convs,
       coalesce(k.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       coalesce(e.hash, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.top = n.path LEFT JOIN nodes p ON p.path = n.parent
LEFT JOIN children k ON k.parent = n.path LEFT JOIN ends e ON e.path = n.path
"""
