"""Language ID (op3), quality voting (op9) and decontamination (op7)."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightdeck.llm import decontaminate, features, language_id, quality_knn

from llm_fixtures import awkward, make, no_docs, sentence  # noqa: F401

SYLLABLES = {"xx": ["ka", "lo", "mi"], "yy": ["sch", "ung", "ber"], "zz": ["eau", "oi", "ier"]}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def test_language_id(spark, no_docs):
    rng = random.Random(3)
    rows = [(1000 + i, spoken(rng, lang, 30), lang) for i in range(90) for lang in [sorted(SYLLABLES)[i % 3]]]
    docs = make(spark, [*rows, *awkward()]).withColumn("held_out", features.fold(F.col("doc_id"), 3) == 1)
    model = language_id.fit(docs.where("NOT held_out"))
    assert model.langs == ["xx", "yy", "zz"] and 0 <= model.reject_below <= 1
    got = language_id.predict(docs, model).collect()
    assert len(got) == docs.count()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 10 and all(r.lang_pred == truth[r.doc_id] for r in held)
    texts = dict(awkward())
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in texts:
            has = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not has)
    nothing = language_id.fit(no_docs.select("doc_id", "text", "lang"))
    assert nothing is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_subwords_do_not_cross_texts():
    both, _ = language_id.subword_counts(["abcd", "efgh"])
    one, _ = language_id.subword_counts(["abcd"])
    two, has = language_id.subword_counts(["efgh", "12 !"])
    assert (both[0] == one[0]).all() and (both[1] == two[0]).all() and has.tolist() == [True, False]


def test_quality_votes(spark, no_docs):
    rng = random.Random(5)
    good = [(i, sentence(rng, 60)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "!!" for w in sentence(rng, 60).upper().split())) for i in range(30)]
    docs = make(spark, [*good, *bad, *((1000 + (k or 0), t) for k, t in awkward())])
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in good + bad] + [(1, 1), (None, 0), (7777, 0), (3, None)],
                                   "doc_id long, quality int")
    voters = quality_knn.learned(docs, labels)
    out = quality_knn.scored(docs, voters)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score"]
    got = {r.doc_id: r.score for r in out.collect()}
    for k, _ in good + bad:
        if k in got:
            assert (got[k] >= 0.3) == (k < 100)
    assert all(0 <= s <= 1 for s in got.values())
    assert got[1006] == pytest.approx(voters.prior)  # the empty text
    assert quality_knn.learned(no_docs, labels) is None
    assert {r.score for r in quality_knn.scored(docs, None).select("score").collect()} == {0.5}


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(200, 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = (rng.random(200) < 0.5).astype(np.float32)
    voters = quality_knn.Voters(np.ones(4), np.eye(8), vectors, labels, 0.5)
    query = vectors[:20] + rng.normal(0, 0.01, (20, 8)).astype(np.float32)
    got = quality_knn.votes(query, voters, 7)
    for q, s in zip(query, got):
        sims = vectors @ q
        near = np.argsort(-sims)[:7]
        w = np.maximum(sims[near], 0) ** quality_knn.SHARPNESS
        assert s == pytest.approx((w * labels[near]).sum() / w.sum(), rel=1e-4)


def test_span_recovers_a_low_rank():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(50, 3)) @ rng.normal(size=(3, 40))).astype(np.float32)
    v = quality_knn.span(x, 3)
    assert np.allclose(x @ v @ v.T, x, atol=1e-3)


def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        p, what = rng.randrange(len(w)), rng.random()
        if what < 1 / 3:
            w[p] = f"new{rng.randrange(99)}"
        elif what < 2 / 3:
            w.insert(p, f"new{rng.randrange(99)}")
        else:
            del w[p]
    return w


def slow_distance(item, text):
    """Edits between ``item`` and the closest stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_best_stretch_is_the_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64)
        text = rng.integers(0, 4, rng.integers(0, 20)).astype(np.uint64)
        d, a, b = decontaminate.best_stretch(item, text)
        assert d == slow_distance(item.tolist(), text.tolist())
        own = text[a:b].tolist()
        full = slow_distance([-1, *item.tolist(), -2], [-1, *own, -2])
        assert 0 <= a <= b <= len(text) and full == d


def test_planted_passages_are_found(spark, no_docs):
    rng = random.Random(6)
    items = [(i, sentence(rng, n, 5000)) for i, n in enumerate((8, 12, 16, 25, 40, 60) * 3)]
    rows, planted = [], set()
    for n, (i, t) in enumerate(items * 4):
        w = t.split()
        k = decontaminate.allowed(len(w)) if n % 2 else 0
        rows.append((n, f"{sentence(rng, 40, 5000)} {' '.join(edited(rng, w, k)).upper()}, {sentence(rng, 40, 5000)}"))
        planted.add((n, i))
    rows += [(900 + n, sentence(rng, 150, 5000)) for n in range(40)]
    rows += [(2000 + (k or 0), t) for k, t in awkward()] + [(990, f"{items[0][1]} {items[0][1]}")]
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (79, "--")], "item_id long, text string")
    docs = make(spark, rows)
    got = decontaminate.contaminated(docs, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.doc_id != 990}
    assert found <= planted and len(found) >= 0.95 * len(planted)
    exact = {(r.doc_id, r.item_id) for r in got if r.distance == 0}
    assert {(n, i) for n, i in planted if n % 2 == 0} <= exact
    assert [(r.first_word, r.stop_word) for r in got if r.doc_id == 990] == [(0, 8), (8, 16)]
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == [c for c in docs.columns]
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {r.doc_id for r in got}
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    none = bench.where("false")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.without_contaminated(docs, none).count() == len(rows)


def test_blocks_of_items_cover_all(spark):
    items = spark.createDataFrame([(i, f"w{i} a b c") for i in range(50)], "item_id long, text string")
    blocks = list(decontaminate.item_blocks(items, block_words=40))
    assert len(blocks) > 3 and sorted(i for b in blocks for i in b.ids) == list(range(50))


@pytest.mark.parametrize("words", ["even", "zipf"])
def test_long_items_are_found_when_edited_to_the_limit(words):
    rng = np.random.default_rng(31)

    def text(n):
        drawn = rng.integers(0, 5000, n) if words == "even" else rng.zipf(1.3, n) % 5000
        return [f"w{x}" for x in drawn]
    items, texts = [], []
    for n in (100, 150, 200, 300, 400, 600):
        for _ in range(10):
            item = text(n)
            near = list(item)
            for j in range(decontaminate.allowed(n)):
                at = int(rng.integers(len(near)))
                if j % 3 == 0:
                    near[at] = f"new{j}"
                elif j % 3 == 1:
                    near.insert(at, f"new{j}")
                else:
                    del near[at]
            texts.append(" ".join([*text(50), *near, *text(50)]))
            items.append((len(items), " ".join(item)))
    block = decontaminate.prepared(items)
    found = {(t, block.ids[i]) for t, i, *_ in decontaminate.matches(texts, block)}
    assert all(sum((x, x) in found for x in range(g, g + 10)) >= 9 for g in range(0, 60, 10))
    assert sum((x, x) in found for x in range(60)) >= 58


def test_one_doc_id_on_a_third_of_the_rows_stays_within_the_draw(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(7, sentence(rng, 12), "de") for _ in range(300)] + [(7, "the very same text", "de")] * 300
    rows += [(i, sentence(rng, 12), "en" if i % 2 else "fr") for i in range(1000, 1600)]
    docs = make(spark, rows)
    taken = []
    real = language_id.train
    monkeypatch.setattr(language_id, "train", lambda x, y, langs: (taken.append(len(y)), real(x, y, langs))[1])
    language_id.fit(docs.select("doc_id", "text", "lang"), per_lang=40)
    assert taken[0] <= 3 * 40
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(1000, 1600)], "doc_id long, quality int")
    voters = quality_knn.fit(docs.select("doc_id", "text"), labels, sample=50)
    assert len(voters.labels) <= 50


def test_term_counts_of_a_block_take_little_memory():
    import tracemalloc

    import pyarrow as pa
    texts = [f"some words of text {i}" for i in range(512)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    want = (quality_knn.term_counts(texts) > 0).sum(0).tolist()
    tracemalloc.start()
    got = next(quality_knn._frequencies(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.column("df").to_pylist() == [*want, 512]
    assert peak < 512 * quality_knn.DIM * 8  # not even one count for each text and term
