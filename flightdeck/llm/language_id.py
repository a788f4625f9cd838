"""Language identification: averaged subword embeddings and a linear softmax.

Subwords are character 2-, 3- and 4-grams of the lower-cased text, with every
non-letter read as a blank, hashed to DIM buckets.  A text is the mean of its
subwords' embeddings; a linear layer and a softmax give the language.  Both layers
are trained by stochastic gradient descent in numpy on at most PER_LANG labelled
rows of each language (a documented bound; chosen by hash, so the same at any
partitioning).  A held-back fifth of these rows calibrates a temperature and the
confidence below which a prediction is rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightdeck.llm.features import blocks, code_points, fold, gram_hash, is_letter

BITS = 13
DIM = 1 << BITS
WIDTH = 16
PER_LANG = 700
UNDETERMINED = "und"


@dataclass
class Model:
    langs: list[str]
    #: embedding times output weights over the temperature: a logit row a bucket
    logits: np.ndarray
    bias: np.ndarray
    #: calibrated confidence below which the operator rejects
    reject_below: float


def subword_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, has_letter): a row of DIM bucket counts for each text."""
    codes, ends = code_points([t.lower() for t in texts])
    letter = is_letter(codes)
    codes = np.where(letter, codes, 32)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    total = np.zeros(len(texts) * DIM)
    for n in (2, 3, 4):
        h = gram_hash(codes, n, n, BITS)
        # a window counts if it starts in a letter or ends in one, within a text
        m = len(h)
        inside = (doc[:m] == doc[n - 1:n - 1 + m]) & (letter[:m] | letter[n - 1:n - 1 + m])
        total += np.bincount(doc[:m][inside] * DIM + h[inside], minlength=len(total))
    has = np.bincount(doc, letter, len(texts)) > 0
    return total.reshape(len(texts), DIM).astype(np.float32), has


def _mean_rows(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], seed: int = 11, epochs: int = 12,
          batch: int = 32, rate: float = 0.5, precision: float = 0.99) -> Model:
    """Fit embeddings and softmax by mini-batch SGD, then calibrate.

    ``x`` holds mean subword rows, ``y`` language numbers; the last fifth of the
    rows calibrates.
    """
    rng = np.random.default_rng(seed)
    cut = max(1, len(x) * 4 // 5)
    embed = rng.normal(0, 0.1, (DIM, WIDTH)).astype(np.float32)
    out = np.zeros((WIDTH, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    out += rng.normal(0, 0.1, out.shape).astype(np.float32)
    # rows of the embedding see tiny frequencies: their step is scaled by the bucket's mean
    scale = (1 / (x[:cut].mean(0) + 1e-4)).astype(np.float32)[:, None]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(cut)
        for i in range(0, cut, batch):
            rows = order[i:i + batch]
            hidden = x[rows] @ embed
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = x[rows].T @ (error @ out.T)
            out -= step * (hidden.T @ error)
            bias -= step * error.sum(0)
            embed -= step * np.clip(back * scale, -1, 1)
    held_x, held_y = (x[cut:], y[cut:]) if cut < len(x) else (x, y)
    z = held_x @ embed @ out + bias
    own = np.arange(len(held_y))
    temps = np.geomspace(0.25, 8, 41)
    loss = [-np.log(np.maximum(_softmax(z / t)[own, held_y], 1e-12)).mean() for t in temps]
    t = float(temps[int(np.argmin(loss))])
    p = _softmax(z / t)
    best, right = p.max(1), p.argmax(1) == held_y
    reject = 1.0
    for limit in np.linspace(1 / len(langs), 0.99, 60):
        kept = best >= limit
        if kept.any() and right[kept].mean() >= precision:
            reject = float(limit)
            break
    return Model(langs, (embed @ out / t).astype(np.float32), (bias / t).astype(np.float32), reject)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for i, j in blocks(batch.column("text"), DIM):
            counts, has = subword_counts(batch.column("text").slice(i, j - i).to_pylist())
            rows = [{"lang": langs[i + k], "cells": np.flatnonzero(counts[k]).astype("<u2").tobytes(),
                     "counts": counts[k][counts[k] > 0].astype("<f4").tobytes()}
                    for k in range(j - i) if has[k]]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("lang", pa.string()), ("cells", pa.binary()), ("counts", pa.binary())]))


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Train on labelled rows of ``docs`` (doc_id, text, lang); None without any.

    Of each language the row with the lowest hash in each of ``per_lang`` cells is
    taken, repeated rows once, so at most ``per_lang`` rows a language reach the driver
    however many rows share a doc_id.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("draw", F.xxhash64("text", "doc_id"))
    drawn = (rows.groupBy("lang", F.pmod("draw", F.lit(per_lang)).alias("cell")).agg(F.min("draw").alias("draw"))
             .select("lang", "draw"))
    # at most per_lang rows a language: small enough to broadcast by that bound
    sample = (rows.join(F.broadcast(drawn), ["lang", "draw"], "left_semi")
              .groupBy("lang", "draw").agg(F.first("text").alias("text")).select("text", "lang"))
    got = sample.mapInArrow(_sampled, "lang string, cells binary, counts binary").collect()
    langs = sorted({r["lang"] for r in got})
    if not langs:
        return None
    got.sort(key=lambda r: (zlib.crc32(r["cells"]), r["cells"], r["counts"], r["lang"]))
    x = np.zeros((len(got), DIM), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["cells"], "<u2")] = np.frombuffer(r["counts"], "<f4")
    y = np.array([langs.index(r["lang"]) for r in got])
    return train(_mean_rows(x), y, langs)


def _predictor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            text, ids, held = (batch.column(c) for c in ("text", "doc_id", "held_out"))
            for i, j in blocks(text, DIM):
                texts = [t or "" for t in text.slice(i, j - i).to_pylist()]
                if m is None:
                    pred, score, low = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
                else:
                    counts, has = subword_counts(texts)
                    p = _softmax(_mean_rows(counts) @ m.logits + m.bias)
                    best = p.argmax(1)
                    pred = [m.langs[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
                    score = np.where(has, p.max(1), 0.0).astype(float)
                    low = ~has | (score < m.reject_below)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), held.slice(i, j - i), pa.array(pred, pa.string()),
                     pa.array(score, pa.float64()), pa.array(low, pa.bool_())],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), one row a row of ``docs``.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing could
    be learned.  ``rejected``: the calibrated confidence is too low to trust.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x languages floats
    return docs.select("doc_id", "text", "held_out").mapInArrow(
        _predictor(shared), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), (fold(F.col("doc_id"), 3) == 1).alias("held_out"))
    model = fit(docs.where("NOT held_out"))
    return predict(docs, model)
