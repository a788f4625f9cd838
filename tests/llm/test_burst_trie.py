"""Burst trie (op12) against a plain trie of Python tuples."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import types as T

from flightdeck.llm import burst_trie
from flightdeck.llm.burst_trie import op12_conversation_trie, trie

from conftest import SMOKE

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       # columns whose names the operator uses itself
                       T.StructField("path", T.StringType()), T.StructField("key", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def plain(rows):
    """rows (conv_id, turn, role, text) -> set of result rows."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:])
    members, kids = {}, {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                kids.setdefault(turns[:d - 1], set()).add(turns[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids.get(node, ()))
        leaves[node] = sum(leaves[k] for k in kids.get(node, ())) or 1
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(kids.get(node, ())), leaves[node],
                   saved[node], hashlib.sha256(",".join(str(c) for c in sorted(m) if full[c] == node).encode()).hexdigest())
                  for node, m in members.items())


def got(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def conversations(rng, n, turns, first=0, spine=0):
    """Conversations of few different turns, so that many prefixes are shared."""
    rows = []
    for c in range(first, first + n):
        common = [("system", f"shared opening line {k}") for k in range(spine)]
        own = [(rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randrange(1, 3)))
               for _ in range(rng.randrange(turns + 1))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(common + own)]
    return rows


@pytest.mark.parametrize("limit", [1, 7, 60, 10**9])
def test_same_trie_at_every_limit(spark, limit):
    rng = random.Random(7)
    rows = conversations(rng, 45, 5) + conversations(rng, 30, 4, 60, 6) + conversations(rng, 6, 0, 200, 9)
    assert got(trie(table(spark, rows), limit)) == plain(rows)


def test_awkward_rows(spark):
    rows = [(1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, None, None, None), (1, 3, "", ""), (1, 2, None, "x\ty"),
            (2, 0, "user", "a b"), (21, 5, "user", ""), (3, 1, "user", "b"), (3, 1, "user", "a"), (None, 0, "user", "lost"),
            (-5, 0, "u", "minus"), (-20, 0, "u", "base"), (-20, 1, "u", "base two"), (40, 0, "r", "only"), (41, 0, "r", "only"),
            (500, 0, "a", "1:b"), (501, 0, "a1:", "b"), (1 << 62, 0, "u", "big")]
    rows += [(7, k, "user", f"turn {k}") for k in range(300)] + [(8, k, "user", f"turn {k}") for k in range(301)]
    for limit in (1, 4096):
        assert got(trie(table(spark, rows), limit)) == plain(rows)


def test_copies_are_one_sequence_and_bursts_split(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(20, 320) for k in range(4, 8)]
    rows += [(c, 4, "user", "t4") for c in range(400, 500)] + [(c, 5, "user", f"own {c}") for c in range(400, 500)]
    assert got(trie(table(spark, rows), 20)) == plain(rows)


def test_empty_table(spark):
    empty = trie(table(spark, []))
    assert empty.count() == 0 and empty.columns[0] == "conv_id"


def test_members_of_one_node_are_hashed_in_chunks(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(1000, 1200)]
    df = spark.createDataFrame([(b"k", c) for _, c in sorted((0, r[0]) for r in rows)], "seq binary, conv_id bigint")
    monkeypatch.setattr(burst_trie, "CHUNK", 16)
    chunks = [x for b in burst_trie._rendered(iter(df.toArrow().to_batches())) for x in b.to_pylist()]
    assert len(chunks) >= 200 // 16
    batches = spark.createDataFrame([(c["seq"], c["first"], c["ids"]) for c in chunks],
                                    "seq binary, first bigint, ids string").toArrow().to_batches()
    ends = [x["ends"] for b in burst_trie._chained(iter(batches)) for x in b.to_pylist()]
    assert ends == [hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()]


def test_query_like_its_sql_and_plain(spark):
    mine = got(op12_conversation_trie(spark, SMOKE))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SMOKE}/conversations.parquet')")
    theirs = sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in con.sql(burst_trie.ORACLE).fetchall())
    assert mine == theirs
    assert mine == plain(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())
