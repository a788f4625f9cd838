"""Filter interaction audit: what each filter removes in every order of all of them.

One stored id table for each filter holds the documents that fail it.  Left-semi and
left-anti joins with one table after the other split the documents into those that
fail it and those that survive, so after the last table every document stands in the
class of the filters that it fails.  A class is what all prefixes need: prefixes are
anti-joined with the classes' failures to find their survivors, semi-joined to find
what the next filter removes or finds already gone.  Documents travel through one pair
of joins a filter, whatever the number of orders; classes are at most 2^filters a part.

Documents are keyed by a digest of (doc_id, part, text) with a count of the rows that
share it, so a key occurs once however often a row is repeated.
"""

from __future__ import annotations

import itertools
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightdeck.llm.common import documents, pinned
from flightdeck.session import scratch_path

WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
LEAST_WORDS = 200
#: Per cent.
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = "[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Filter letter -> the text fails it, for the filters that see one text alone."""
    words = F.array_remove(F.split(text, WORD_SPLIT), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < LEAST_WORDS,
            "B": F.lit(100) * distinct < F.lit(LEAST_DISTINCT) * n,
            "C": F.lit(100) * capitals > F.lit(MOST_CAPITALS) * F.char_length(text),
            "D": text.rlike(MARKS)}


def units(docs: DataFrame) -> DataFrame:
    """(unit, doc_id, part, n, fails): distinct documents, their rows and failed filters.

    A NULL text is empty, a NULL source the part ''.  E fails where a smaller doc_id
    has the same text; a NULL doc_id is neither smaller than another nor has one that
    is smaller, and rows that repeat a doc_id do not fail by each other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    alone = text_failures(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                       F.concat(*[F.when(c, F.lit(f)).otherwise(F.lit("")) for f, c in alone.items()]).alias("fails"))
    # repeated rows are counted before they travel
    rows = pinned(rows.groupBy("doc_id", "part", "digest").agg(F.first("fails").alias("fails"),
                                                                F.count(F.lit(1)).alias("n")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    # texts that only one document has need no look at another; stored, so that the join
    # reads two plain shuffles and copies of a text are split
    first = pinned(first.where("copies > 1").drop("copies"), "audit-firsts")
    repeated = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return rows.join(first, "digest", "left").select(
        F.unhex(F.md5(F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                                  F.hex("digest"), "part").cast("binary"))).alias("unit"),
        "doc_id", "part", "n", F.concat("fails", F.when(repeated, F.lit("E")).otherwise(F.lit(""))).alias("fails"))


def failing_ids(spark: SparkSession, found: DataFrame, filters: str) -> dict[str, DataFrame]:
    """Filter letter -> stored table (unit) of the documents that fail it."""
    path = scratch_path(spark, "failing-ids")
    rows = found.select("unit", F.explode(F.split("fails", "")).alias("filter")).where(F.col("filter") != "")
    rows.write.partitionBy("filter").parquet(path)
    stored = spark.read.schema("unit binary, filter string").parquet(path)
    return {f: stored.where(F.col("filter") == f).select("unit") for f in filters}


def classes(found: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, part, class, n): rows of each document under the letters it fails.

    ``found`` is split by a left-semi and a left-anti join with one id table after the
    other; each split is stored, so the next reads it twice without redoing it.
    """
    rows = found.select("unit", "doc_id", "part", "n", F.lit("").alias("class"))
    for f, failing in tables.items():
        rows = pinned(rows.join(failing, "unit", "left_semi").withColumn("class", F.concat("class", F.lit(f)))
                      .unionByName(rows.join(failing, "unit", "left_anti")), f"audit-{f}")
    return rows.groupBy("doc_id", "part", "class").agg(F.sum("n").alias("n"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, class, n, good, toxic): document counts, and those with either label.

    A doc_id labelled more than once counts as good if any of its labels says so,
    toxic likewise; NULL ids have no label.
    """
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic")))
    return (rows.join(known, "doc_id", "left").groupBy("part", "class")
            .agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(f"is_{c}"), F.col("n"))), F.lit(0)).alias(c)
                                          for c in ("good", "toxic")]))


def _subsets(letters: str) -> list[str]:
    return ["".join(c) for k in range(len(letters) + 1) for c in itertools.combinations(letters, k)]


def audit_prefixes(spark: SparkSession, counted: DataFrame, filters: str) -> DataFrame:
    """One row for each (part, before, filter): what the filter does after ``before``.

    ``before`` is the set of filters applied earlier; their order does not change who
    survives.  The joins' right sides name classes and sets only: 2^(2 filters) rows.
    """
    fails = spark.createDataFrame([(c, f) for c in _subsets(filters) for f in c], "class string, filter string")
    gone = spark.createDataFrame([(c, b) for c in _subsets(filters) for b in _subsets(filters) if set(b) & set(c)],
                                 "class string, before string")
    steps = [(b, f) for f in filters for b in _subsets(filters.replace(f, ""))]
    step = F.explode(F.array(*[F.struct(F.lit(b).alias("before"), F.lit(f).alias("filter")) for b, f in steps]))
    cells = counted.select("*", step.alias("step")).select("part", "class", "n", "good", "toxic", "step.*")
    fails, gone = F.broadcast(fails), F.broadcast(gone)
    survivors = cells.join(gone, ["class", "before"], "left_anti")
    removed = survivors.join(fails, ["class", "filter"], "left_semi")
    redundant = (cells.join(gone, ["class", "before"], "left_semi").join(fails, ["class", "filter"], "left_semi"))
    kept = survivors.join(fails, ["class", "filter"], "left_anti")
    # a document that fails this filter and no other
    only = cells.where(F.col("class") == F.col("filter"))
    columns = {"kept": (kept, "n"), "removed": (removed, "n"), "redundant": (redundant, "n"), "unique_fails": (only, "n"),
               "good_lost": (removed, "good"), "toxic_lost": (removed, "toxic")}
    found = cells.select("part", "before", "filter", *[F.lit(0).cast("long").alias(c) for c in columns])
    for name, (rows, what) in columns.items():
        found = found.unionByName(rows.select("part", "before", "filter", *[
            (F.col(what) if c == name else F.lit(0)).cast("long").alias(c) for c in columns]))
    return found.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in columns])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every order of the five filters, step by step, for each part of ``docs``.

    Reads doc_id, text and source; other columns are not looked at.  NULLs, empty
    texts and repeated rows: see ``units`` and ``with_labels``; each repeated row is a
    document of its own in the counts.  An empty table has no part and gives no row.
    """
    spark, filters = docs.sparkSession, "ABCDE"
    found = pinned(units(docs), "audit-units")
    counted = with_labels(classes(found, failing_ids(spark, found, filters)), labels)
    prefixes = pinned(audit_prefixes(spark, pinned(counted, "audit-classes"), filters), "audit-prefixes")
    last = len(filters) - 1
    weight = F.array(*[F.lit(factorial(k) * factorial(last - k)) for k in range(len(filters))])
    shapley = prefixes.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.element_at(weight, F.char_length("before") + 1)).alias("shapley"))
    orders = spark.createDataFrame(
        [("".join(o), k + 1, "".join(sorted(o[:k])), o[k]) for o in itertools.permutations(filters)
         for k in range(len(filters))], "filter_order string, step int, before string, filter string")
    return (prefixes.join(F.broadcast(orders), ["before", "filter"]).join(shapley, ["part", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over all documents and labels."""
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), words AS (
  SELECT d.*, f.first_id,
         regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') AS words
  FROM docs d JOIN firsts f ON f.text = d.text
), marked AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS a,
         CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS b,
         CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 1 ELSE 0 END AS c,
         CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
         CASE WHEN doc_id > first_id THEN 1 ELSE 0 END AS e
  FROM words
), labelled AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), classes AS (
  SELECT part, a * 1 + b * 2 + c * 4 + d * 8 + e * 16 AS class, count(*) AS n,
         coalesce(sum(l.good), 0) AS good, coalesce(sum(l.toxic), 0) AS toxic
  FROM marked m LEFT JOIN labelled l ON l.doc_id = m.doc_id GROUP BY 1, 2
), letters(letter, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order,
         [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE (v.bit | w.bit | x.bit | y.bit | z.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN (class & (before | bit)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (class & bit) <> 0 AND (class & before) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (class & bit) <> 0 AND (class & before) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN class = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (class & bit) <> 0 AND (class & before) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (class & bit) <> 0 AND (class & before) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM classes, steps GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
