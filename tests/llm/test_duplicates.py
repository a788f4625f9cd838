"""N-gram Jaccard join (op8) and duplicate substrings (op10) against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
import pytest

from flightdeck.llm import common, jaccard_join, pfp_dedup

from llm_fixtures import awkward, make, no_docs, sentence  # noqa: F401

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = {}
    for k, t in rows:
        sets[k] = shingles(t)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    low = lambda k: (k is not None, k)  # noqa: E731  NULL first
    keys = sorted(sets, key=low)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)), key=low)
                parent[q] = p
    return {k: (len(sets[k]), find(k)) for k in keys}


def near_group(rng, n, first):
    """``n`` edits of one text, from hardly to heavily changed, and copies."""
    words = sentence(rng, 60).split()
    out = []
    for i in range(n):
        w = list(words)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(40)}"
        out.append((first + i, " ".join(w)))
    return out


@pytest.mark.parametrize("small", [jaccard_join.SMALL, 3])
def test_components_match_brute_force(spark, small, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", small)  # 3: nearly all buckets take the centre's way
    rng = random.Random(8)
    passage = sentence(rng, 60)
    rows = awkward() + near_group(rng, 45, 100) + near_group(rng, 10, 300)
    rows += [(400 + i, f"{passage} {sentence(rng, 12)}") for i in range(25)]
    rows += [(500 + i, sentence(rng, rng.randrange(1, 9), 3)) for i in range(30)]
    want = brute_components(rows)
    got = jaccard_join.components(make(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_texts_under_one_doc_id_are_documents_of_their_own(spark):
    rng = random.Random(21)
    texts = [sentence(rng, 60) for _ in range(8)]
    rows = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:6]] + [(9, texts[6])]
    # near copies: of a text without id, of one of the repeated id, of the plain one
    rows += [(20, texts[1] + " x"), (5, texts[4] + " y"), (30, texts[6] + " z"), (None, texts[2] + " w"), (7, texts[5])]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.components(make(spark, rows)).collect()),
                 key=str)
    ids = {"20": None, "5": 5, "30": 9, "9": 9}
    want = [(k, len(shingles(t)), 5 if t == texts[4] else ids.get(str(k), k)) for k, t in rows]
    assert got == sorted(want, key=str)


def test_components_of_nothing(spark, no_docs):
    assert jaccard_join.components(no_docs).count() == 0
    assert jaccard_join.components(make(spark, [(1, None), (2, ""), (3, " ")])).select(
        "doc_id", "n_shingles", "component_id").orderBy("doc_id").collect() == [(i, 0, i) for i in (1, 2, 3)]


def test_word_hashes_do_not_depend_on_their_batch():
    texts = [t.encode() for _, t in awkward() if t]
    alone = [jaccard_join.word_hashes(np.frombuffer(t, np.uint8), np.array([len(t)]))[0] for t in texts]
    together, doc = jaccard_join.word_hashes(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]))
    for i, a in enumerate(alone):
        assert (together[doc == i] == a).all() and (doc == i).sum() == len(a)
        assert len(set(a.tolist())) == len(set(re.findall(b"[^\x20\x09-\x0D]+", texts[i].lower())))


def test_contraction_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (60, 59), (149, 200)]
    got = dict(map(tuple, common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (*range(100, 150), 200)}, 59: 59, 60: 59}


def brute_removed(rows):
    """(bytes, kept) by document: a window counts if a smaller doc_id starts it too."""
    first = {}
    low = [(k if k is not None else -1, (t or "").encode()) for k, t in rows]
    for k, raw in low:
        for i in range(len(raw) - 49):
            w = raw[i:i + 50]
            first[w] = min(first.get(w, k), k)
    out = []
    for k, raw in low:
        gone = bytearray(len(raw))
        end = 0
        for i in range(len(raw) - 49):
            if first[raw[i:i + 50]] < k:
                a = max(i, end)
                gone[a:i + 50] = b"\1" * (i + 50 - a)
                end = i + 50
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = gone.count(b"\0\1") + (gone[:1] == b"\1")
        out.append((k, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_removed(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in df.collect())


def test_duplicate_substrings_match_brute_force(spark, no_docs):
    rng = random.Random(9)
    rows = awkward()
    passages = [sentence(rng, 30) for _ in range(4)]
    for i in range(40):
        parts = [sentence(rng, rng.randrange(0, 20)) for _ in range(3)]
        p = rng.choice(passages)
        a = rng.randrange(0, 60)
        b = rng.choice((a + 49, a + 50, a + 51, a + 90))
        rows.append((600 + i, parts[0] + p[a:b] + parts[1] + rng.choice(passages) + rng.choice(passages) + parts[2]))
    rows += [(700, "ab" * 60), (701, "ab" * 60 + "c"), (702, "Orre " * 40), (703, "Orre " * 30 + "x"),
             (704, "é" * 49), (705, "é" * 60)]
    assert got_removed(pfp_dedup.deduplicated(make(spark, rows))) == brute_removed(rows)
    assert pfp_dedup.deduplicated(no_docs).count() == 0


def test_hot_triggers_are_spread_and_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pfp_dedup, "HOT", 3)
    rng = random.Random(33)
    line = "Terms of use apply to every single page that this site ever serves."
    rows = awkward() + [(600 + i, f"{sentence(rng, 9)} {line[:rng.choice((25, 49, 50, 67))]} {sentence(rng, 9)}") for i in range(60)]
    # the strings of one trigger go to every partition
    names = np.arange(100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    dealt = pfp_dedup._dealt([(names, *[np.arange(100)] * 3)], 7)
    assert sorted(r["part"] for r in dealt) == list(range(-7, 0))
    assert got_removed(pfp_dedup.deduplicated(make(spark, rows))) == brute_removed(rows)


def test_a_run_of_texts_answers_each_part_once():
    import pyarrow as pa
    rng = random.Random(34)
    parts, passage = 5, sentence(rng, 60)
    rows = [(i, f"{sentence(rng, 9)} {passage[:rng.randrange(60, 200)]} {sentence(rng, 9)}") for i in range(80)] + [(3, "x" * 90), (81, "")]
    ids, text, tag = zip(*[(k, t, j) for j, (k, t) in enumerate(rows)])
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(text), pa.array(tag, pa.int32())], names=["doc_id", "text", "tag"])
    sent = pa.Table.from_batches(pfp_dedup._sender(parts)(iter([batch])))
    marks = {}
    for q in range(parts):
        own = sent.filter(pa.compute.equal(sent["part"], q))
        for r in pfp_dedup._dictionary((pa.scalar(q),), own, 4096).to_pylist():
            marks.setdefault((r["doc_id"], r["tag"]), []).append({"part": r["part"], "marks": r["marks"]})
    squeezed = {(k, g): z for b in pfp_dedup._squeeze(iter([batch])) for k, g, z in zip(*[b.column(c).to_pylist() for c in ("doc_id", "tag", "squeezed")])}
    kind = pa.list_(pa.struct([("part", pa.int32()), ("marks", pa.binary())]))
    joined = pa.RecordBatch.from_arrays([pa.array([k for k, _ in marks], pa.int64()), pa.array([g for _, g in marks], pa.int32()),
                                         pa.array([squeezed[k] for k in marks], pa.binary()), pa.array(list(marks.values()), kind)],
                                        names=["doc_id", "tag", "squeezed", "marks"])
    for given in (joined.slice(10), joined):
        answers = pa.Table.from_batches(pfp_dedup._answer(parts)(iter([given])))
        asked = [q for q in answers["part"].to_pylist() if q is not None]
        assert len(asked) == len(set(asked)) > 1
    assert any(r["spans"] for q in asked for r in pfp_dedup._suffixes((pa.scalar(q),), answers.filter(
        pa.compute.equal(answers["part"], q))).to_pylist())


def test_phrases_bound_every_string_of_texts_laid_end_to_end():
    rng = random.Random(35)
    texts = [sentence(rng, rng.choice((0, 1, 5, 9, 10, 11, 40))).encode()[:rng.choice((49, 50, 51, 400))] for _ in range(200)] + [b""]
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    p = pfp_dedup.parse(data, ends)
    begin = ends - [len(t) for t in texts]
    got = [(d, s) for d, a, b in zip(p["doc"].tolist(), p["first"], p["last"]) for s in range(a - begin[d], b + 1 - begin[d])]
    assert got == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 49)]
    assert ((p["first"] <= p["at"]) & (p["at"] <= p["first"] + 30) & (p["last"] <= p["at"])).all()


def test_texts_beyond_the_position_width_are_parsed_in_pieces(spark, monkeypatch):
    import pyarrow as pa
    rng = random.Random(10)
    long = (sentence(rng, 300) + " ").encode()
    whole = pfp_dedup.parse(np.frombuffer(long, np.uint8), np.array([len(long)]))
    strings = [s for a, b in zip(whole["first"], whole["last"]) for s in range(a, b + 1)]
    assert strings == list(range(len(long) - 49))
    chunks = list(pfp_dedup._chunks(pa.array([long.decode()]), 100))
    assert len(chunks) == 1 and chunks[0][3][0] == 0


def test_equal_strings_have_equal_triggers():
    rng = random.Random(11)
    passage = sentence(rng, 12).encode()[:70]
    found = []
    for before in (b"", b"zz", sentence(rng, 9).encode()):
        data = np.frombuffer(before + passage + b"tail" * 20, np.uint8)
        p = pfp_dedup.parse(data, np.array([len(data)]))
        j = int(np.flatnonzero((p["first"] <= len(before) + 10) & (p["last"] >= len(before) + 10))[0])
        found.append((int(p["trigger"][j]), int(p["at"][j]) - len(before)))
    assert len(set(found)) == 1
