"""Token files (op2) and packing (op5) against the tokenizers library itself."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flightdeck.llm import packing, repair_store, tokenization
from flightdeck.session import scratch_path

from llm_fixtures import awkward, no_docs, odd_docs, tokenizers_paths  # noqa: F401


def plain_ids(path, text):
    from tokenizers import Tokenizer
    t = plain_ids.cache.setdefault(path, Tokenizer.from_file(path))
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


plain_ids.cache = {}


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_pieces_encode_like_whole_texts(tokenizers_paths, kind):
    texts = [t for _, t in awkward()] + [
        "don't we'll 'S", "a. b, c! d.\ne", "x.,y", "İstanbul ſK ²", "<|endoftext|>", "\x01 a\x02", "tail ", "\nhead",
        "12.5 3rd 4,000", "a,b , c", ". , .", "A.\nB", "ÀÉÎ Straße"]
    path = tokenizers_paths[kind]
    ids, ends = tokenization.PieceEncoder(path, kind).encode(pa.array(texts))
    got = np.split(ids, ends[:-1])
    assert [g.tolist() for g in got] == [plain_ids(path, t) for t in texts]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_added_tokens_are_encoded_as_the_untouched_library_does(tokenizers_paths, kind):
    from tokenizers import Tokenizer
    path = tokenizers_paths[kind]
    library = Tokenizer.from_file(path)
    literals = [t.content for t in library.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in literals
    texts = ["no literal here"] + [f for t in literals for f in (
        t, f"a {t} b", f"a{t}b", f"a {t.upper()} b", f"x. {t}, y\n{t}", f"two  blanks {t}")]
    ids, ends = tokenization.PieceEncoder(path, kind).encode(pa.array(texts))
    assert [g.tolist() for g in np.split(ids, ends[:-1])] == [
        [*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_encoder_forgets_rare_pieces_and_stays_right(tokenizers_paths, monkeypatch):
    monkeypatch.setattr(tokenization, "CACHE_PIECES", 30)
    enc = tokenization.PieceEncoder(tokenizers_paths["byte"], "byte")
    for n in range(6):
        texts = [f"common word {n * 100 + i}th thing{i}" for i in range(20)]
        ids, ends = enc.encode(pa.array(texts))
        assert [g.tolist() for g in np.split(ids, ends[:-1])] == [plain_ids(tokenizers_paths["byte"], t) for t in texts]


@pytest.mark.parametrize("kind", ["byte", "word"])
def test_a_piece_that_two_marks_lead_to_keeps_later_batches_right(tokenizers_paths, kind):
    # "." opens one text and follows a letter in another: one piece, met twice in a batch
    enc = tokenization.PieceEncoder(tokenizers_paths[kind], kind)
    for texts in ([". abc", "foo. bar zeta"], ["gamma delta", "zeta bar\n\nx", "", None, "x<|endoftext|>y  z"],
                  ["zeta bar foo. bar zeta"], [], [None]):
        ids, ends = enc.encode(pa.array(texts, pa.string()))
        assert [g.tolist() for g in np.split(ids, ends[:-1])][:len(texts)] == [
            plain_ids(tokenizers_paths[kind], t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=0, max_size=40), min_size=1, max_size=12))
def test_repair_round_trip_and_random_access(docs):
    counts = np.array([len(d) + 1 for d in docs])
    ids = np.array([t for d in docs for t in [*d, 0]])
    row = repair_store._shard_row(0, 0, 0, ids, list(range(len(docs))), counts, 7)
    assert len(row["doc_offsets"]) == len(docs)
    for i, d in enumerate(docs):
        whole = [*d, 0]
        assert repair_store.read_ids(row, i).tolist() == whole
        for lo, hi in ((0, 1), (len(d) // 2, len(d)), (1, 3), (len(d), len(d) + 1)):
            assert repair_store.read_ids(row, i, lo, hi).tolist() == whole[lo:hi]


def test_repair_makes_rules_that_pay():
    ids = np.tile([5, 6, 7, 8], 500)
    seq, rules, lengths = repair_store.compress(ids, 99, 100)
    assert len(seq) < 100 and (lengths >= 2).all()
    assert repair_store.expand(seq, rules, 100).tolist() == ids.tolist()


def test_repair_widens_symbols_when_sixteen_bits_are_used_up():
    rng = np.random.default_rng(36)
    grams = rng.integers(0, 50_257, (16_000, 4))
    ids = np.append(grams[rng.permutation(np.repeat(np.arange(16_000), 4))].ravel(), 50_257)
    seq, rules, _ = repair_store.compress(ids, 50_257, 50_258)
    assert 50_258 + len(rules) > 1 << 16
    inner = seq[:-1]
    assert np.unique(inner[:-1] << 32 | inner[1:], return_counts=True)[1].max() < 4
    assert repair_store.expand(seq, rules, 50_258).tolist() == ids.tolist()
    ids[-1] = 0
    row = repair_store._shard_row(0, 0, 0, ids, [7], np.array([len(ids)]), 50_257)
    assert row["width"] == 4 and repair_store.read_ids(row, 0, 100, 900).tolist() == ids[100:900].tolist()


def test_frequent_pairs_are_found_alike_with_narrow_and_wide_symbols():
    rng = np.random.default_rng(37)
    left, right = rng.integers(0, 40, (2, 5_000))
    key = left << 32 | right
    pairs, counts = np.unique(key, return_counts=True)
    for n_symbols in (40, 1 << 30):
        got, count, place = repair_store._frequent(left, right, n_symbols, 4)
        assert got.tolist() == pairs[counts >= 4].tolist() and count.tolist() == counts[counts >= 4].tolist()
        assert key[place].tolist() == np.repeat(got, count).tolist() and len(set(place.tolist())) == len(place)
        assert all(not len(x) for x in repair_store._frequent(left[:0], right[:0], n_symbols, 4))


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(35)
    ids = np.concatenate([np.tile(rng.integers(0, 90, 1000), 200), rng.integers(0, 90, 20_000)])
    seq, rules, lengths = repair_store.compress(ids, 99, 100)
    pairs, counts = np.unique(seq[:-1] << 32 | seq[1:], return_counts=True)
    # overlapping occurrences of one symbol over and over aside
    assert counts[pairs >> 32 != pairs & 0xFFFFFFFF].max() < 4
    assert lengths.max() > 256 and repair_store.expand(seq, rules, 100).tolist() == ids.tolist()
    for most in (1, 7, 64, 1 << 20):
        assert repair_store.expand_all(seq, rules, lengths, 100, most).tolist() == ids.tolist()
    assert not len(repair_store.expand_all(seq[:0], rules[:0], lengths[:0], 100))


def test_token_files(spark, odd_docs, no_docs, tokenizers_paths):
    path = tokenizers_paths["byte"]
    out = scratch_path(spark, "test-ids")
    repair_store.write_ids(odd_docs, out, path, shard_tokens=500)
    got = sorted(map(tuple, repair_store.read_documents(spark, out)
                     .select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    assert [r[1] for r in got] == sorted((k for k, _ in awkward()), key=lambda k: (k is not None, k))
    start = 0
    texts = {}
    for k, t in awkward():
        texts.setdefault(k, []).append(t)
    for s, doc, n, crc in got:
        ids = plain_ids(path, texts[doc][0])
        assert (s, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    empty = scratch_path(spark, "test-ids")
    repair_store.write_ids(no_docs, empty, path)
    assert repair_store.read_documents(spark, empty).count() == 0


def test_packing(spark, odd_docs, no_docs, tokenizers_paths):
    path = tokenizers_paths["word"]
    got = packing.packed_documents(odd_docs, path).collect()
    assert len({(r.doc_id, r.piece) for r in got}) == len({(k, i) for k, t in awkward()
                                                           for i in range(-(-len(plain_ids(path, t)) // 2048))})
    texts = dict(awkward())
    by_seq = {}
    for r in got:
        ids = plain_ids(path, texts[r.doc_id])
        part = np.array(ids[r.piece * 2048:(r.piece + 1) * 2048], "<u4")
        assert (r.start, r.length, r.ids_crc32) == (r.piece * 2048, len(part), zlib.crc32(part.tobytes()))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_seq) == -(-sum(r.length for r in got) // 2048)
    assert packing.packed_documents(no_docs, path).count() == 0


def test_equal_pieces_spread_over_the_problems(spark):
    same = spark.range(6_000).selectExpr("cast(null as long) doc_id", "0 piece", "0L start", "700L length", "9L ids_crc32")
    sizes = [r["count"] for r in packing.dealt(same, 1_000).groupBy("problem").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1_200
    got = packing.pack(same, 2_048, problem_pieces=1_000).collect()
    assert len(got) == 6_000
    fill = {}
    for r in got:
        fill.setdefault(r["sequence_id"], set()).add(r["offset"])
    assert all(x <= {0, 700} for x in fill.values()) and len(fill) <= 3_006


def test_islands_meet_the_bound_where_best_fit_decreasing_does_not():
    # best-fit decreasing needs 5 sequences here; 4 are enough
    lengths = np.array([44, 44, 44, 44, 29, 29, 28, 28, 27, 27, 28, 28])
    seq = packing.evolve(lengths, 100, 1, [], population=8, offspring=200)
    fill = np.bincount(seq, lengths)
    assert fill.max() <= 100 and fill.sum() == lengths.sum()
    rng = np.random.default_rng(0)
    child = packing.crossover(lengths, seq, packing.mutate(lengths, seq, 100, rng), 100, rng)
    assert len(child) == len(lengths) and np.bincount(child, lengths).max() <= 100


def test_packing_leaves_no_pieces_in_a_waiting_worker(tokenizers_paths):
    import pyarrow as pa
    path = tokenizers_paths["word"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["one two three", None])], names=["doc_id", "text"])
    found = [r for b in packing._cutter(path, "word", 2048)(iter([batch, batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in found] == [1, 2, 1, 2] and found[:2] == found[2:]
    assert not tokenization.encoder(path, "word").known
