"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed character 3-grams, 5-grams of character shapes (upper, lower,
digit, mark, blank) and marks for words that repeat a recent word.  Term weights are
log counts times the inverse document frequency over all documents.  A randomised
SVD of at most SAMPLE labelled rows (a documented bound, drawn by hash) spans the
latent space; the same rows are the voters.  Every document's cosine to every voter
is computed exactly, in blocks; its K nearest voters vote with their similarity.
Voters and projection have a size that SAMPLE, DIM and WIDTH fix, so they are
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightdeck.llm.common import give_back, released
from flightdeck.llm.features import blocks, code_points, fold, gram_hash

BITS = 12
DIM = 1 << BITS
WIDTH = 48
SAMPLE = 4000
K = 15
#: Rows whose terms are counted together: their arrays are many times the text.
COUNTED = 128
#: Similarity to this power is a neighbour's weight.
SHARPNESS = 4.0
#: Score from which a document counts as good.
THRESHOLD = 0.3


@dataclass
class Voters:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _shapes(codes: np.ndarray) -> np.ndarray:
    """0 blank, 1 lower-case or other letter, 2 capital A-Z, 3 digit, else the mark."""
    out = np.where(codes > 127, 1, codes)
    out = np.where((codes >= 97) & (codes <= 122), 1, out)
    out = np.where((codes >= 65) & (codes <= 90), 2, out)
    out = np.where((codes >= 48) & (codes <= 57), 3, out)
    return np.where((codes == 32) | ((codes >= 9) & (codes <= 13)), 0, out).astype(np.uint32)


def term_counts(texts: list[str]) -> np.ndarray:
    """A row of DIM term counts for each text."""
    codes, ends = code_points(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    total = np.zeros(len(texts) * DIM)
    shapes = _shapes(codes)
    for seq, n, salt in ((codes, 3, 101), (shapes, 5, 202)):
        h = gram_hash(seq, n, salt, BITS)
        inside = doc[:len(h)] == doc[n - 1:n - 1 + len(h)]
        total += np.bincount(doc[:len(h)][inside] * DIM + h[inside], minlength=len(total))
    # words that equal one of the three words before them
    word = shapes != 0
    first = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]])) if len(codes) else np.zeros(0, np.int64)
    if len(first):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + 7) * np.uint64(0x9E3779B97F4A7C15))])
        last = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
        mixed = (prefix[last] - prefix[first]) ^ (codes[first].astype(np.uint64) << np.uint64(40)) \
            ^ (last - first).astype(np.uint64)
        of = doc[first]
        for back in (1, 2, 3):
            same = np.flatnonzero((mixed[back:] == mixed[:-back]) & (of[back:] == of[:-back]))
            total += np.bincount(of[same] * DIM + (back - 1), minlength=len(total))
    return total.reshape(len(texts), DIM)


def _counted(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, term counts) of runs of COUNTED texts."""
    for k in range(0, len(texts), COUNTED):
        yield k, term_counts([t or "" for t in texts.slice(k, COUNTED).to_pylist()])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        text = batch.column("text")
        for i, j in blocks(text, DIM):
            for _, counts in _counted(text.slice(i, j - i)):
                df += (counts > 0).sum(0)
        n += batch.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([*range(DIM), -1], pa.int32()), pa.array([*df.tolist(), n])],
                                         names=["term", "df"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, label = batch.column("text"), batch.column("label").to_pylist()
        for i, j in blocks(text, DIM):
            counts = term_counts([t or "" for t in text.slice(i, j - i).to_pylist()])
            yield pa.RecordBatch.from_pylist(
                [{"label": label[i + k], "terms": np.flatnonzero(c).astype("<u2").tobytes(),
                  "counts": c[c > 0].astype("<f4").tobytes()} for k, c in enumerate(counts)],
                schema=pa.schema([("label", pa.int32()), ("terms", pa.binary()), ("counts", pa.binary())]))


def span(x: np.ndarray, width: int, seed: int = 5, rounds: int = 3) -> np.ndarray:
    """The leading right singular vectors of ``x``, by randomised power iteration."""
    width = min(width, *x.shape)
    q = np.random.default_rng(seed).normal(size=(x.shape[1], width)).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Voters | None:
    """Voters from ``labels`` (doc_id, label) over ``docs`` (doc_id, text).

    Document frequencies cover all of ``docs``.  The ``sample`` labelled ids with
    the lowest hash are used; a doc_id labelled twice takes the smaller label, one with
    several texts the text that hashes lowest, so at most ``sample`` rows reach the
    driver; None without any labelled text.
    """
    rows = docs.mapInArrow(released(_frequencies), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in rows.collect()}  # DIM + 1 rows
    n = df.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([df.get(t, 0) for t in range(DIM)]))) + 0.1
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    drawn = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
             .agg(F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")))
    got = (drawn.select("label", "text").mapInArrow(released(_sparse), "label int, terms binary, counts binary").collect())
    if not got:
        return None
    got.sort(key=lambda r: (r["terms"], r["counts"], r["label"]))
    x = np.zeros((len(got), DIM), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["terms"], "<u2")] = np.frombuffer(r["counts"], "<f4")
    x = weighted(x, idf)
    y = np.array([r["label"] for r in got], np.float32)
    basis = span(x, WIDTH)
    return Voters(idf, basis, _unit(x @ basis).astype(np.float32), y, float(y.mean()))


def votes(vectors: np.ndarray, voters: Voters, k: int = K) -> np.ndarray:
    """Similarity-weighted share of label 1 among the ``k`` nearest voters."""
    sims = vectors @ voters.vectors.T
    k = min(k, sims.shape[1])
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(sims, near, 1), 0) ** SHARPNESS
    total = weight.sum(1)
    return np.where(total > 1e-9, (weight * voters.labels[near]).sum(1) / np.maximum(total, 1e-9), voters.prior)


def _scorer(shared):
    def score(text: pa.Array) -> pa.Array:
        voters = shared.value
        scores = np.full(len(text), 0.5)
        for i, j in blocks(text, DIM) if voters is not None else ():
            x = np.empty((j - i, DIM), np.float32)
            for k, counts in _counted(text.slice(i, j - i)):
                x[k:k + len(counts)] = weighted(counts, voters.idf)
            scores[i:j] = votes(_unit(x @ voters.basis), voters)
            del x
        give_back()
        return pa.array(np.clip(scores, 0, 1))
    return score


def scored(docs: DataFrame, voters: Voters | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1); all rows and other columns are kept.

    A NULL or empty text has no direction and scores the share of good voters; 0.5
    where there are no voters; a column named score is replaced.  Only the text goes to
    Python, once, and only the score comes back: the rows stay with Spark.
    """
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    # called nondeterministic so that no rule copies it into a filter as well
    score = F.arrow_udf(_scorer(shared), T.DoubleType()).asNondeterministic()
    return docs.drop("score").withColumn("score", score(F.col(text_col).cast("string")))


def learned(docs: DataFrame, labels: DataFrame) -> Voters | None:
    """Voters for ``documents`` from the rows outside the held-out fifth."""
    return fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
               labels.where(fold(F.col("doc_id"), 5) != 0))


def op9_quality_neighbours(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    voters = learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, voters).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
