"""Awkward documents for the tests of this folder."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(20_000))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns whose names the operators use themselves
    T.StructField("key", T.StringType()), T.StructField("part", T.StringType()),
    T.StructField("n", T.StringType()), T.StructField("rep", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("slot", T.StringType()), T.StructField("__text", T.StringType())])


def make(spark, rows):
    """Rows of (doc_id, text[, lang]) with extra columns whose names clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]),
             *["clash"] * 8) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


def awkward():
    """NULLs, empty, blank and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(4)
    base = sentence(rng, 80)
    near = base.split()
    near[40] = "changed"
    passage = sentence(rng, 60)
    rows = [(3, base), (1, base), (7, " ".join(near)), (5, None), (6, ""), (8, " \t\n"), (9, "one two"),
            (10, "One  two"), (11, LONG), (12, LONG), (13, passage + " " + sentence(rng, 90)),
            (14, sentence(rng, 70) + " " + passage), (15, "x" * 300), (16, "ab" * 200), (2, sentence(rng, 300)),
            (17, "naïve 😀 Ünïcode　 text\x1cwith blanks\r\n\n end "), (18, "!"), (19, "a"),
            (20, passage), (None, sentence(rng, 40)), (21, passage + " x"), (22, "y" * 300)]
    return [*rows, rows[0], rows[3]]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return make(spark, awkward()).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizers_paths():
    public = pytest.importorskip("public_tokenizers")
    return {"byte": public.path("byte_bpe_50k.json"), "word": public.path("word_bpe_49k.json")}
