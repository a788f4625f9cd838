"""Secret scan (op1), syncmers (op4) and sharding (op6)."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from flightdeck.llm import secret_scan, sharding, syncmers

from llm_fixtures import awkward, make, no_docs, odd_docs  # noqa: F401

WORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                 for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"({WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secret_texts():
    rng = random.Random(1)
    rnd = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    hexes = "0123456789abcdef"
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [f"é😀 password: {rnd(hexes, 12)} and token = \"{rnd(hexes, 40)}\" end", "password: token: abcdefgh",
             "SECRET='abc' api_key=abcdef apikey: 'ab.cd-ef'", "AKIA" + "B" * 16, "AKIA" + "B" * 15, "token==abcdef",
             f"{rnd(hexes, 24)} {rnd(hexes, 23)}", "a" * 24, "ſecret=abcdefg toKen=abcdefg",
             "passwordpasswd=abcdefgh", "token=abcdef\nsecret : xyzxyz1"]
    texts += [f"key {rnd(b64, 44)} tail" for _ in range(40)]
    texts += [f"slug {'word' * 4}{i % 10}{'text' * 3}" for i in range(20)]
    return texts


def test_secret_scan(spark, no_docs):
    rows = [*awkward(), *((100 + i, t) for i, t in enumerate(secret_texts()))]
    docs = make(spark, rows)
    out = secret_scan.scan(docs)
    assert set(docs.columns) <= set(out.columns)
    got = out.select("doc_id", "text", "base", "spans").collect()
    assert len(got) == len(rows)
    random_found = collections.Counter()
    for r in got:
        want = base(r.text or "")
        assert [tuple(s) for s in r.base] == want
        spans = [tuple(s) for s in r.spans]
        assert spans == sorted(spans) and set(want) <= set(spans)
        for a, kind, b in spans:
            if kind == 3:
                random_found[r.text[:4]] += 1
    assert random_found["key "] >= 36 and random_found["slug"] == 0
    assert secret_scan.scan(no_docs).count() == 0


def test_lone_keys_among_wordy_runs_are_found(spark):
    rng = random.Random(32)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    found = planted = slugs = 0
    # a key of each length class, alone in its class but for wordy runs
    for turn in range(3):
        keys = ["".join(rng.choice(a) for _ in range(n)) for n in (20, 44, 80, 150) for a in (letters + "0123456789+/", letters)]
        texts = [f"key {k} tail" for k in keys]
        texts += [f"slug how-to-build-a-house-in-{1900 + i}-and-not-lose-it/{'word' * (i % 9)}" for i in range(30)]
        for r in secret_scan.scan(make(spark, list(enumerate(texts)))).select("text", "spans").collect():
            hit = any(s.kind == 3 for s in r.spans)
            found, slugs = found + (hit and r.text[:3] == "key"), slugs + (hit and r.text[:4] == "slug")
        planted += len(keys)
    assert found >= planted - 2 and slugs == 0


def test_redaction_removes_every_span(spark):
    rows = [(i, t) for i, t in enumerate(secret_texts())]
    out = secret_scan.scan(make(spark, rows)).withColumn(
        "clean", secret_scan.redacted(F.col("text"), F.col("spans"))).collect()
    for r in out:
        want, at = "", 0
        for a, _, b in r.spans:
            if a >= at or not want:
                want += r.text[at:a] + secret_scan.REDACTED
            at = max(at, b)
        assert r.clean == want + r.text[at:]
        assert not base(r.clean)


def test_closed_syncmers_follow_their_definition(spark):
    text = "the quick brown fox jumps over the lazy dog and runs far away"
    row = syncmers.with_anchors(make(spark, [(1, text)]).select("text"), F.col("text"), "anchors")
    words = text.split()
    hashed = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string")
              .select(F.xxhash64("w")).collect()]
    seq = [*range(-1, -5, -1), *hashed, *range(-1, -5, -1)]
    inner = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(seq, seq[1:]))], "i int, a long, b long")
    s = [r[0] for r in inner.orderBy("i").select(F.xxhash64("a", "b")).collect()]
    kept = [i for i in range(len(seq) - 4) if min(s[i], s[i + 3]) == min(s[i:i + 4])]
    mers = spark.createDataFrame([(n, *seq[i:i + 5]) for n, i in enumerate(kept)],
                                 "n int, a long, b long, c long, d long, e long")
    want = [r[0] & 0xFFFFFF for r in mers.orderBy("n").select(F.xxhash64("a", "b", "c", "d", "e")).collect()]
    assert row.first()["anchors"] == want


def test_fingerprints(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 4000)
    got = syncmers.fingerprints(odd_docs).select(
        "doc_id", "text", "next_text", "n_chars", syncmers.printed(F.col("anchors")).alias("f"),
        syncmers.likeness(F.col("anchors"), F.col("next_anchors")).alias("near")).collect()
    rows = sorted(((-1 if k is None else k), t or "") for k, t in awkward())
    ids = [k for k, _ in rows]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got) == ids
    by_text = {}
    for r in got:
        k = -1 if r.doc_id is None else r.doc_id
        later = [i for i in ids if i > k] or [min(ids)]
        options = {t for i, t in rows if i == later[0]} | {t for i, t in rows if i == k and ids.count(k) > 1}
        assert r.next_text in options and r.n_chars == len(r.text)
        assert by_text.setdefault(r.text, r.f) == r.f
        assert 0 <= r.near <= 1 and (r.text != r.next_text or r.near == 1)
        assert bool(r.f) == bool(r.text.strip(" \t\n"))
    assert syncmers.fingerprints(no_docs).count() == 0


def test_syncmers_resist_edits(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(9999)}" for _ in range(300)]
    edited = [*words[:100], "inserted", *words[101:]]
    pair = spark.createDataFrame([(" ".join(words), " ".join(edited), "other text " * 30)], "a string, b string, c string")
    for c in "abc":
        pair = syncmers.with_anchors(pair, F.col(c), c + "f")
    r = pair.select(syncmers.likeness(F.col("af"), F.col("bf")).alias("ab"),
                    syncmers.likeness(F.col("af"), F.col("cf")).alias("ac"),
                    syncmers.matched(F.col("af"), F.col("bf")).alias("m")).first()
    assert r.ab > 0.95 and r.ac < 0.05
    assert all(abs(m.a - m.b) <= 3 for m in r.m)


def test_syncmers_resist_edits_of_text_without_blanks(spark):
    rng = random.Random(34)
    run = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(1500))
    pair = spark.createDataFrame([(run, "\u4e00" + run, run[:700] + run[701:])], "a string, b string, c string")
    for c in "abc":
        pair = syncmers.with_anchors(pair, F.col(c), c + "f", whole=True)
    r = pair.select(syncmers.likeness(F.col("af"), F.col("bf")).alias("ab"),
                    syncmers.likeness(F.col("af"), F.col("cf")).alias("ac"), F.size("af").alias("n"),
                    F.size(F.filter("af", lambda x: F.abs(x) > 1 << 32)).alias("wide")).first()
    assert r.ab > 0.95 and r.ac > 0.95 and r.n > 500 and r.wide > 0.9 * r.n


def brute_table(names, size):
    def h(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)
    prefs = []
    for n in names:
        first, factor = h(n + ":offset") % size, h(n + ":step") % (size - 1) + 1
        prefs.append(sorted(range(size), key=lambda s: (s - first) * factor % size))
    owner, at, t = {}, [0] * len(names), 0
    while len(owner) < size:
        i = t % len(names)
        while prefs[i][at[i]] in owner:
            at[i] += 1
        owner[prefs[i][at[i]]] = names[i]
        t += 1
    return owner


def test_lookup_table(spark):
    names = [f"shard-{i}" for i in range(7)]
    table = {r.slot: r.shard for r in sharding.lookup_table(spark, names, 211).collect()}
    assert table == brute_table(names, 211)
    counts = collections.Counter(table.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = brute_table(names[:-1], 211)
    moved = sum(table[s] != fewer[s] for s in table if table[s] != names[-1])
    assert moved <= 0.25 * 211


def test_placement(spark, odd_docs, no_docs):
    got = sharding.placed(odd_docs, "doc_id", ["a", "b", "c"], 101)
    assert got.count() == odd_docs.count() and got.where("shard IS NULL OR slot IS NULL").count() == 0
    assert got.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    assert sharding.placed(no_docs, "doc_id", ["a"], 2).count() == 0


def test_sharding_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sharding.op6_permutation_table_sharding(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(sharding.ORACLE).fetchall())
