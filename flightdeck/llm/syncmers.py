"""Closed-syncmer fingerprints of whole texts.

A text is read as pieces: runs of up to 8 non-blank characters are pieces, of a longer
run every 8 characters in a row are one, so that the pieces after an edit do not
depend on the run's start.  Of its k-mers of K
pieces, those are kept whose minimal inner S-mer (by hash) is the first or the last
one.  Whether a k-mer is kept depends on the k-mer alone, so an edit disturbs only
the k-mers that hold it, and the kept ones are anchors with positions.  Two marks
before and after the text give short texts anchors too.

The fingerprint is the lowest 24 bits of the anchors' hashes in text order, six
hexadecimal digits each.  The likeness of two texts is Dice's coefficient of their
distinct 64-bit anchors; ``matched`` pairs the positions of common anchors.

DataFrame functions only.  Neighbours in doc_id order come from a window within
ranges of doc_ids; each range also gets the first document of the next one, so no
window spans more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightdeck.llm.common import NULL_ID, id_text, text_bytes

#: Pieces in a k-mer, and in an inner s-mer.
K, S = 5, 2
PIECE = r"(?=([^\x20\x09-\x0D]{8}|(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,7}(?![^\x20\x09-\x0D])))"
#: Quantiles of doc_id that bound the ranges; larger tables cut each range again.
QUANTILES = 512
RANGE_BYTES = 16 << 20


def with_anchors(df: DataFrame, text: Column, name: str, whole: bool = False) -> DataFrame:
    """``df`` with ``name``: array<int> of 24-bit anchor hashes in text order.

    ``whole`` keeps all 64 bits, as array<bigint>: 24 are alike by chance in long texts.
    Empty where the text is NULL, empty or blank.  The steps are columns of their
    own, so each array is computed once a row.
    """
    pad = [F.lit(-j).cast("long") for j in range(1, K)]
    last = K - S  # inner s-mers are numbered 0..last

    def kept(i):
        inner = [F.get("__m", i + j) for j in range(last + 1)]
        edge = F.least(inner[0], inner[-1])
        return edge <= F.least(*inner[1:-1])

    def code(i):
        hashed = F.xxhash64(*[F.get("__w", i + j) for j in range(K)])
        return hashed if whole else hashed.bitwiseAND(0xFFFFFF).cast("int")

    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(1)),
                        lambda w: F.xxhash64(w))
    return (df.withColumn("__w", words)
            .withColumn("__w", F.when(F.size("__w") > 0, F.concat(F.array(*pad), "__w", F.array(*pad)))
                        .otherwise(F.array().cast("array<bigint>")))
            .withColumn("__m", F.when(F.size("__w") > 0, F.transform(
                F.sequence(F.lit(0), F.size("__w") - S),
                lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(S)]))))
            .withColumn(name, F.when(F.size("__w") > 0, F.transform(F.filter(
                F.sequence(F.lit(0), F.size("__w") - K), kept), code))
                .otherwise(F.array().cast("array<bigint>" if whole else "array<int>")))
            .drop("__w", "__m"))


def printed(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda a: F.lower(F.lpad(F.hex(a.bitwiseAND(0xFFFFFF)), 6, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice's coefficient of distinct anchors; 1 where both have none."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def matched(a: Column, b: Column) -> Column:
    """(position in a, position in b) of each anchor's first places, in a's order."""
    return F.transform(F.array_intersect(a, b), lambda x: F.struct(
        (F.array_position(a, x) - 1).alias("a"), (F.array_position(b, x) - 1).alias("b")))


def _ranged(base: DataFrame) -> DataFrame:
    """``base`` (doc_id, text) with ``range`` and ``ghost``, equal doc_ids in one range.

    ``ghost`` 1 marks the copy of a range's first document that is put at the end
    of the range before (of the last, for the first range).
    """
    ids = base.select("doc_id")
    n_ranges = max(1, -(-text_bytes(base) // RANGE_BYTES))
    quantiles = min(QUANTILES, n_ranges)
    bounds = ids.select(F.percentile_approx(
        "doc_id", [i / quantiles for i in range(quantiles + 1)], 100 * QUANTILES).alias("q")).first()["q"]
    if bounds is None:
        return base.withColumns({"range": F.lit(0), "ghost": F.lit(0)})
    bounds = sorted(set(bounds))
    cells = -(-n_ranges // quantiles)
    edges = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    at = F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))
    place = at
    if cells > 1:
        low, high = F.get(edges, at - 1), F.get(edges, at)
        place = at * (cells + 2) + F.coalesce(
            F.width_bucket("doc_id", low.cast("double"), high.cast("double"), F.lit(cells)), F.lit(0))
    placed = base.withColumn("range", place)
    firsts = placed.groupBy("range").agg(F.min("doc_id").alias("first"))  # a row a range
    order = Window.orderBy("range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(F.col("first").alias("doc_id"), F.coalesce(
        F.lag("range").over(order), F.max("range").over(whole)).alias("range"))
    ghosts = base.join(F.broadcast(firsts), "doc_id")
    return (placed.withColumn("ghost", F.lit(0))
            .unionByName(ghosts.withColumn("ghost", F.lit(1)).select("doc_id", "text", "range", "ghost")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_chars, next_text, anchors, next_anchors), one row a document.

    ``next`` is the document of the next doc_id in order, the first after the last;
    among equal doc_ids the hash of the text decides.  A NULL text is empty, a NULL
    doc_id sorts first, an only document follows itself, extra columns are dropped,
    an empty table gives no row.
    """
    base = id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID).cast("long")))
    rows = with_anchors(_ranged(base), F.col("text"), "anchors", whole=True)
    order = Window.partitionBy("range").orderBy("ghost", "doc_id", "__tie")
    return (rows.withColumn("__tie", F.xxhash64("text")).withColumn("next_text", F.lead("text").over(order))
            .withColumn("next_anchors", F.lead("anchors").over(order))
            .where("ghost = 0").drop("range", "ghost", "__tie")
            .withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id"))))


def op4_syncmer_fingerprints(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    part = F.floor(F.col("n_chars") / 4).cast("int")
    rows = fingerprints(documents(spark, sf_dir)).withColumn("edited", F.concat(
        F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"), F.left("next_text", part)))
    rows = with_anchors(rows.drop("text", "next_text"), F.col("edited"), "edited_anchors", whole=True)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("anchors")).alias("fingerprint"),
        printed(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
