"""Digest cache (op11): counts of the library itself, distinct misses only, versions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flightdeck.llm import token_cache
from flightdeck.llm.token_cache import DigestCache, op11_digest_cached_counts, token_counts, tokenizer_digest
from flightdeck.session import scratch_path

from conftest import SMOKE
from llm_fixtures import awkward, make, no_docs, odd_docs  # noqa: F401

public = pytest.importorskip("public_tokenizers")
PIECES = public.path("piece_bpe_32k.model")
BYTES = public.path("byte_bpe_50k.json")


def plain(path, text):
    if path.endswith(".model"):
        import sentencepiece
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    from tokenizers import Tokenizer
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("path", [PIECES, BYTES])
def test_counts_of_the_library(spark, odd_docs, path):
    cache = DigestCache(spark, scratch_path(spark, "test-cache"))
    got = token_counts(odd_docs, path, cache)
    assert got.columns == [*[c for c in odd_docs.columns if c != "text"], "n_bytes", "n_tokens"]
    rows = sorted((r["doc_id"] is not None, r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect())
    assert rows == sorted((i is not None, i, len((t or "").encode()), plain(path, t)) for i, t in awkward())


def test_special_strings_and_copies(spark):
    texts = ["<s>a</s>", "<|endoftext|> x", "a\x00b", "▁ ▁a", " lead", "tail \n", "ﬁ Ⅷ é é", "", None, "<unk>"]
    docs = make(spark, [(i, t) for i, t in enumerate(texts)] + [(100 + i, "same text") for i in range(50)])
    for path in (PIECES, BYTES):
        cache = DigestCache(spark, scratch_path(spark, "test-cache"))
        got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, path, cache).collect()}
        assert got == {i: plain(path, t) for i, t in enumerate(texts)} | {100 + i: plain(path, "same text") for i in range(50)}
        # NULL and empty are one content, fifty copies one more
        assert cache.counts(tokenizer_digest(path)).count() == len(texts) - 1 + 1


def test_only_misses_are_encoded_and_added(spark, monkeypatch):
    cache = DigestCache(spark, scratch_path(spark, "test-cache"))
    version = tokenizer_digest(PIECES)
    token_counts(make(spark, [(1, "one"), (2, "two")]), PIECES, cache)
    # stored counts are trusted: a changed one shows that nothing is encoded again
    cache.add(cache.counts(version).select("digest", (F.col("n_tokens") + 1000).alias("n_tokens")), version)
    added = []
    real = DigestCache.add
    monkeypatch.setattr(DigestCache, "add", lambda self, rows, v: (added.append(rows.count()), real(self, rows, v)))
    got = {r["doc_id"]: r["n_tokens"] for r in
           token_counts(make(spark, [(3, "two"), (4, "one"), (5, "three"), (6, "three")]), PIECES, cache).collect()}
    assert got[3] == 1000 + plain(PIECES, "two") and got[4] == 1000 + plain(PIECES, "one")
    assert got[5] == got[6] == plain(PIECES, "three")
    assert added == [1]
    token_counts(make(spark, [(7, "three"), (8, "one")]), PIECES, cache)
    assert added == [1]


def test_another_tokenizer_misses(spark, tmp_path):
    cache = DigestCache(spark, scratch_path(spark, "test-cache"))
    docs = make(spark, [(1, "some words here")])
    token_counts(docs, PIECES, cache)
    got = token_counts(docs, BYTES, cache).first()["n_tokens"]
    assert got == plain(BYTES, "some words here")
    changed = tmp_path / "v.json"
    changed.write_bytes(open(BYTES, "rb").read() + b"\n")
    assert len({tokenizer_digest(p) for p in (PIECES, BYTES, str(changed))}) == 3
    with pytest.raises(ValueError):
        tokenizer_digest("words.txt")


def test_normalised_content_is_the_key(spark):
    cache = DigestCache(spark, scratch_path(spark, "test-cache"))
    docs = make(spark, [(1, " a b"), (2, "a b "), (3, "a b")])
    got = token_counts(docs, BYTES, cache, normalise=lambda c: F.trim(token_cache.empty_for_null(c)))
    assert {r["n_tokens"] for r in got.collect()} == {plain(BYTES, "a b")}
    assert cache.counts(tokenizer_digest(BYTES)).count() == 1


def test_empty_table(spark, no_docs):
    cache = DigestCache(spark, scratch_path(spark, "test-cache"))
    assert token_counts(no_docs, PIECES, cache).count() == 0


def test_query(spark):
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), n := len(pieces.encode(r["text"] or "")), n > 4096)
                  for r in docs)
    got = op11_digest_cached_counts(spark, SMOKE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == want
