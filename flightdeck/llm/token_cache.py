"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content, a tokenizer's the SHA-256 of its
file, its library and the library's version.  Counts are looked up in a stored table
(tokenizer, digest) -> n_tokens; only distinct digests that the table lacks are
encoded, each once however many rows share it, and appended.

The bundled vocabularies' own normalizers differ, so normalisation here only makes
NULL an empty text; a caller whose tokenizer folds more passes ``normalise``.  Rows
with the same digest cross to Python at most once per run; a run that meets no new
text starts no Python worker.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from importlib import metadata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.llm.common import documents, pinned, spare
from flightdeck.llm.tokenization import slices
from flightdeck.session import scratch_path

#: Documents with more tokens are marked.
LIMIT = 4096

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def empty_for_null(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def library_of(path: str) -> str:
    """The library that reads a vocabulary file: by its ending."""
    kinds = {".json": "tokenizers", ".model": "sentencepiece"}
    ending = os.path.splitext(path)[1]
    if ending not in kinds:
        raise ValueError(f"no library reads vocabulary files ending in {ending!r}")
    return kinds[ending]


def tokenizer_digest(path: str) -> str:
    """Hex SHA-256 of library, version and file: another vocabulary or release misses."""
    library = library_of(path)
    seen = hashlib.sha256(f"{library} {metadata.version(library)}\n".encode())
    with open(path, "rb") as file:
        while block := file.read(1 << 20):
            seen.update(block)
    return seen.hexdigest()


def _load(path: str) -> Callable[[list[str]], list[int]]:
    """A function texts -> numbers of tokens, without special, cut or padding tokens."""
    if library_of(path) == "sentencepiece":
        import sentencepiece
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    words = Tokenizer.from_file(path)
    words.no_truncation()
    words.no_padding()
    return lambda texts: [len(e.ids) for e in words.encode_batch(texts, add_special_tokens=False)]


_LOADED: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The worker's tokenizer for a file, kept between batches."""
    if path not in _LOADED:
        _LOADED[path] = _load(path)
    return _LOADED[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            text = batch.column("text")
            for i, j in slices(text, 4 << 20):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("digest").slice(i, j - i), pa.array(count(text.slice(i, j - i).to_pylist()), pa.int64())],
                    names=["digest", "n_tokens"])
    return run


class DigestCache:
    """Counts stored under ``path``, one partition folder for each tokenizer digest.

    Rows are only ever added.  A lost executor's task is run again; a driver lost
    while appending leaves whole files or none of a task, and a digest that two runs
    add at once is there twice with one count: ``counts`` gives it once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # makes the folder where it is missing, and adds nothing where it is not
        self._append(spark.createDataFrame([], CACHE_SCHEMA))

    def _append(self, rows: DataFrame):
        rows.write.mode("append").partitionBy("tokenizer").parquet(self.path)

    def counts(self, tokenizer: str) -> DataFrame:
        """(digest, n_tokens) known for a tokenizer digest."""
        return (self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
                .where(F.col("tokenizer") == tokenizer)
                .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))

    def add(self, counted: DataFrame, tokenizer: str):
        self._append(counted.select("digest", "n_tokens", F.lit(tokenizer).alias("tokenizer")))


def token_counts(docs: DataFrame, path: str, cache: DigestCache, text_col: str = "text",
                 normalise: Callable[[Column], Column] = empty_for_null) -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` and ``n_tokens`` of the whole text.

    A NULL text counts as empty; repeated rows, texts and doc_ids, NULL doc_ids and
    any other columns stay as they are (a column named n_bytes or n_tokens is
    replaced).  An empty table gives an empty one.  After the call the cache holds
    every text of ``docs``.
    """
    version = tokenizer_digest(path)
    digest = spare(docs, "content_digest")
    text = normalise(F.col(text_col))
    hashed = F.unhex(F.sha2(text.cast("binary"), 256))
    others = [c for c in docs.columns if c.lower() not in (text_col.lower(), "n_bytes", "n_tokens")]
    keyed = pinned(docs.select(*others, F.octet_length(empty_for_null(F.col(text_col))).cast("long").alias("n_bytes"),
                               hashed.alias(digest)), "token-keys")
    known = cache.counts(version)
    misses = pinned(keyed.select(F.col(digest).alias("digest")).distinct().join(known, "digest", "left_anti"), "token-misses")
    if not misses.isEmpty():
        # one text a digest, picked before and after the shuffle: copies never travel
        texts = docs.select(hashed.alias("digest"), text.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
        cache.add(texts.join(misses, "digest", "left_semi").mapInArrow(_encode(path), "digest binary, n_tokens bigint"),
                  version)
        known = cache.counts(version)
    # stored, so that the join reads two plain shuffles and copies of a text are split
    found = pinned(known.withColumnRenamed("digest", digest), "token-found")
    return keyed.join(found, digest, "left").drop(digest)


def op11_digest_cached_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary, from an empty cache."""
    import public_tokenizers
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cache = DigestCache(spark, scratch_path(spark, "token-cache"))
    counted = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), cache)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
