"""Filter audit (op13) against plain sets of documents."""

from __future__ import annotations

import itertools
import random
import re

import duckdb
from pyspark.sql import types as T

from flightdeck.llm import filter_audit
from flightdeck.llm.filter_audit import audit, op13_filter_audit

from conftest import SMOKE
from llm_fixtures import awkward, make, no_docs  # noqa: F401

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType()), T.StructField("part", T.StringType())])
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
           "shapley"]


def plain(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic) -> set of result rows."""
    rows = [(i, t or "", s or "") for i, t, s in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def fails(i, text):
        words = re.findall("[^\x20\x09-\x0D]+", text)
        found = {"A"} if len(words) < 200 else set()
        if 100 * len(set(words)) < 50 * len(words):
            found.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            found.add("C")
        if re.search("[#$%&*|]", text):
            found.add("D")
        if i is not None and any(t == text and j is not None and j < i for j, t, _ in rows):
            found.add("E")
        return found
    known = [(i, s, fails(i, t)) for i, t, s in rows]
    out = {}
    for part in {s for _, _, s in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [(i, f) for i, s, f in known if s == part]
            whole = left
            for k, letter in enumerate(order):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(letter in f for _, f in whole) - len(gone),
                    sum(f == {letter} for _, f in whole), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    total = {}
    for (part, order, step), row in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + row[1]
    return {(*key, *row, total[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def with_sources(spark, rows):
    docs = make(spark, [(i, t) for i, t, _ in rows])
    names = docs.columns
    full = [tuple({"doc_id": i, "text": t, "source": s, "n_chars": 0}.get(c, "clash") for c in names) for i, t, s in rows]
    return spark.createDataFrame(full, docs.schema).repartition(3)


def random_rows(rng):
    def text():
        words = [rng.choice(["aa", "bb", "Cc", "x$"]) if rng.random() < .5 else f"w{rng.randrange(300)}"
                 for _ in range(rng.choice([0, 3, 150, 230]))]
        return rng.choice(["", " "]) + rng.choice([" ", "\n", "\t"]).join(words) + rng.choice(["", " ", "ÀB"])
    texts = [text() for _ in range(25)] + [None, "", "A"]
    return [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "web", "books"])) for _ in range(70)]


def test_all_orders_like_plain_sets(spark):
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = random_rows(rng)
        rows += rows[:5]
        labels = [(rng.choice([None, *range(30)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(40)]
        got = audit(with_sources(spark, rows), spark.createDataFrame([(*r, "clash") for r in labels], LABELS))
        assert got.columns == COLUMNS
        assert {tuple(r) for r in got.collect()} == plain(rows, labels)


def test_awkward_texts(spark):
    rows = [(i, t, "s") for i, t in awkward()]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, None), (11, 1, 1), (None, 1, 1)]
    got = audit(with_sources(spark, rows), spark.createDataFrame([(*r, "clash") for r in labels], LABELS))
    assert {tuple(r) for r in got.collect()} == plain(rows, labels)


def test_empty_tables(spark, no_docs):
    none = spark.createDataFrame([], LABELS)
    assert audit(no_docs, none).count() == 0
    got = audit(with_sources(spark, [(1, "a", "s")]), none).collect()
    assert len(got) == 600 and {r["good_lost"] for r in got} == {0}


def test_id_tables_hold_one_row_a_document(spark):
    rows = [(1, "same", "s"), (2, "same", "s"), (2, "same", "s"), (3, "same $", "t")]
    found = filter_audit.units(with_sources(spark, rows))
    tables = filter_audit.failing_ids(spark, found, "ABCDE")
    assert {f: t.count() for f, t in tables.items()} == {"A": 3, "B": 0, "C": 0, "D": 1, "E": 1}


def test_query_like_its_sql_and_plain(spark):
    got = {tuple(r) for r in op13_filter_audit(spark, SMOKE).collect()}
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    assert got == set(con.sql(filter_audit.ORACLE).fetchall())
    rows = con.sql("SELECT doc_id, text, source FROM documents").fetchall()
    assert got == plain(rows, con.sql("SELECT doc_id, quality, toxic FROM labels").fetchall())
