"""Exact n-gram Jaccard join by vertical partitioning of the global n-gram order.

1. Every document's distinct word shingles, as 64-bit hashes, are cut by hash into
   vertical partitions.  One shuffle carries them, packed: a row holds the hashes
   that one batch of documents has in one partition.
2. A partition counts the documents of each shingle.  (document frequency, hash) is
   the global order.  Shingles of one document never overlap, so only the shared
   ones go on, to their documents, each with its partition's fragment number.
   A node is a document, named by its doc_id; rows whose doc_id has several sets are
   named by their set instead, so no two different texts are ever one node.
3. Documents with equal sets form a class; its smallest node stands for it.
   In the global order a similar pair must share one of the first
   n - ceil(0.75 n) + 1 shingles.  A document whose own rare shingles fill that
   prefix takes no further part.
4. Documents that share a prefix shingle are candidates: all pairs of a small
   bucket; in a large one each document with the bucket's most central document.
5. The overlap of a candidate pair is counted fragment by fragment and summed per
   pair.  The sum is exact, for what is not shared cannot overlap.
6. A pair of a large bucket of which one is not linked with the centre h is still
   compared unless the counts rule it out: in every cell of every fragment
   |a & b| is at most min(|a & h|, |b & h|) + min(|a - h|, |b - h|) over shared
   shingles.  A pair whose both documents are linked with h is in one component
   already.
7. Links are contracted to components.

No bucket is capped, and no link between different sets is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightdeck.llm import tokenization
from flightdeck.llm.common import released, NULL_ID, connected_components, parts_for, pinned, spare, text_bytes

WORDS = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
SHARE = 75
#: Text bytes for each vertical partition, and fragments in which overlaps are counted.
BYTES_PER_PART = 12 << 20
FRAGMENTS = 4
#: Cells of a fragment, for the bounds of pairs in large buckets.
CELLS = 16
#: Bytes of a shingle hash in the packed rows; its partition tells the rest.
HASH_BYTES = 6
#: Text bytes hashed at once (their arrays stay small) and packed together.
HASHED, PACKED = 1 << 17, 8 << 20
#: Buckets up to this size are joined pair by pair.
SMALL = 16
#: Salts over which one centre's documents are spread.
SALTS = 8
#: Bits of the map of doc_ids that have several sets, and those of one of its rows.
MAP_BITS, ROW_BITS = 1 << 23, 1 << 15

_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * _R)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]), dtype=np.uint64)


def word_hashes(data: np.ndarray, ends: np.ndarray, blanks: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each word of concatenated UTF-8 texts, A-Z lower-cased.

    A word's hash is a polynomial of random byte codes, taken from one running sum
    by shifting it back to power 0; a word never crosses a text's end.  ``blanks``
    tells the bytes that part words.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = blanks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    first = np.flatnonzero(~blank & (np.concatenate([[True], blank[:-1]]) | edge[:-1]
                                     | np.concatenate([[True], np.zeros(len(data) - 1, bool)])))
    last = np.flatnonzero(~blank & (np.concatenate([blank[1:], [True]]) | edge[1:])) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        _BYTE_CODE[_LOWER[data]] * _powers(_R, len(data))[:-1], dtype=np.uint64)])
    raw = (sums[last] - sums[first]) * _powers(_R_INVERSE, len(data))[first]
    doc = np.searchsorted(ends, first, "right")
    return _mix(raw ^ ((last - first).astype(np.uint64) * _R)), doc


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles of each text, by document, hash."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts.to_pylist()]
    ends = np.cumsum([len(r) for r in raw])
    words, doc = word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends)
    if not len(words):
        return words, doc
    n = len(words)
    has = np.bincount(doc, minlength=len(raw))
    grams = np.zeros(n, np.uint64)
    inside = np.ones(n, bool)
    # a document with fewer words has its whole sequence as one shingle
    size = np.minimum(has, WORDS)[doc]
    at = np.arange(n)
    for j in range(WORDS):
        k = np.minimum(at + j, n - 1)
        use = j < size
        inside &= ~use | ((at + j < n) & (doc[k] == doc))
        grams = np.where(use, _mix(grams * _R + words[k]), grams)
    grams, doc = grams[inside] ^ size[inside].astype(np.uint64), doc[inside]
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[fresh], doc[fresh]


def _pooled_sets(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, stop, hashes, text numbers from ``start``) of runs of about PACKED bytes."""
    for i, j in tokenization.slices(text, PACKED):
        part = text.slice(i, j - i)
        found = []
        for a, b in tokenization.slices(part, HASHED):
            grams, doc = shingle_sets(part.slice(a, b - a))
            found.append((grams, doc + a))
        yield i, j, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, ids = batch.column("text"), batch.column("doc_id")
        for i, j, grams, doc in _pooled_sets(text):
            n = np.bincount(doc, minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), batch.column("mark").slice(i, j - i), pa.array(n, pa.int64()),
                 pa.array(_set_sums(grams, n, 1)), pa.array(_set_sums(grams, n, 2))],
                names=["doc_id", "mark", "n", "sig1", "sig2"])


def _set_sums(grams: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
    """A signature of each set; ``n`` tells how many of the grams each one has."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(grams * _R + np.uint64(salt)), dtype=np.uint64)])
    stop = np.cumsum(n)
    return (total[stop] - total[stop - n]).view(np.int64)


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(MAP_BITS))


def _crowded(sigs: DataFrame) -> np.ndarray | None:
    """Per slot, whether a doc_id of it has several sets; None if no doc_id has.

    At most MAP_BITS bits reach the driver.  A doc_id that shares the slot of a
    crowded one is named by its set too, which is as good a name.
    """
    several = (sigs.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("sig1", "sig2") for f in (F.min, F.max)])
               .where("min_sig1 <> max_sig1 OR min_sig2 <> max_sig2").select(_slot(F.col("doc_id")).alias("slot")))
    rows = (several.groupBy(F.floor(F.col("slot") / ROW_BITS).cast("int").alias("row"))
            .agg(F.bitmap_construct_agg(F.pmod("slot", F.lit(ROW_BITS))).alias("bits")).collect())
    if not rows:
        return None
    out = np.zeros((MAP_BITS // ROW_BITS, ROW_BITS), bool)
    for r in rows:
        out[r["row"]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return out.ravel()


def _noded(sigs: DataFrame, shared) -> DataFrame:
    """``sigs`` with ``node``; ``shared`` is the broadcast map of crowded doc_ids or None."""
    if shared is None:
        return sigs.withColumn("node", F.col("doc_id"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, ids, sums = (np.asarray(batch.column(c)) for c in ("slot", "doc_id", "sig1"))
            yield batch.drop_columns(["slot"]).append_column("node", pa.array(np.where(shared.value[slot], sums, ids)))
    return sigs.withColumn("slot", _slot(F.col("doc_id"))).mapInArrow(
        name, "doc_id long, mark long, n long, sig1 long, sig2 long, node long")


def _packer(parts: int, shared):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            nodes = np.asarray(batch.column("doc_id"), dtype=np.int64)
            by_set = None if shared is None else shared.value[np.asarray(batch.column("slot"))]
            for i, j, grams, doc in _pooled_sets(text):
                ids = nodes[i:j]
                if by_set is not None and by_set[i:j].any():
                    ids = np.where(by_set[i:j], _set_sums(grams, np.bincount(doc, minlength=j - i), 1), ids)
                if not len(grams):
                    continue
                # 16 bits are sorted by counting
                part = (grams % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
                order = np.argsort(part, kind="stable")
                grams, own, key = grams[order], ids[doc[order]], part[order]
                del doc, part, order
                rest = np.floor_divide(grams, np.uint64(parts), out=grams)
                cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
                rows = []
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    who, counts = _runs(own[a:b])
                    # steps between nodes repeat, so the shuffle compresses them away
                    rows.append({"part": int(key[a]), "docs": np.diff(who, prepend=0).astype("<i8").tobytes(),
                                 "counts": counts.astype("<u4").tobytes(),
                                 "grams": rest[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                        [("part", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary())]))
    return pack


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return x[cut], np.diff(np.append(cut, len(x)))


def _counter(parts: int, repeated: bool):
    def count(key, rows):
        part = key[0].as_py()
        docs = [np.cumsum(np.frombuffer(d, "<i8")) for d in rows.column("docs").to_pylist()]
        counts = [np.frombuffer(c, "<u4") for c in rows.column("counts").to_pylist()]
        own = np.repeat(np.concatenate(docs), np.concatenate(counts))
        short = np.frombuffer(b"".join(rows.column("grams").to_pylist()), np.uint8).reshape(-1, HASH_BYTES)
        grams = np.zeros((len(short), 8), np.uint8)
        grams[:, :HASH_BYTES] = short
        grams = grams.view("<u8").ravel()
        order = np.lexsort((own, grams)) if repeated else np.argsort(grams, kind="stable")
        grams, own = grams[order], own[order]
        if repeated:  # rows with one set are one node
            fresh = np.concatenate([[True], (grams[1:] != grams[:-1]) | (own[1:] != own[:-1])])
            grams, own = grams[fresh], own[fresh]
        first, n = _runs(grams)
        df = np.repeat(n, n)
        shared = df > 1
        gram = (grams[shared] * np.uint64(parts) + np.uint64(part)).view(np.int64)
        return pa.table({"doc_id": pa.array(own[shared]), "gram": pa.array(gram), "df": pa.array(df[shared], pa.int64())})
    return count


def _sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, shared): sizes, signatures, nodes; the shingles that two rows have, by node."""
    sigs = pinned(docs.mapInArrow(released(_signatures), "doc_id long, mark long, n long, sig1 long, sig2 long"),
                  "shingle-sizes")
    crowded = _crowded(sigs)
    if crowded is not None:
        crowded = docs.sparkSession.sparkContext.broadcast(crowded)  # MAP_BITS bytes
        docs = docs.withColumn("slot", _slot(F.col("doc_id")))
    parts = parts_for(text_bytes(docs), BYTES_PER_PART)
    packed = docs.drop("mark").mapInArrow(released(_packer(parts, crowded)), "part int, docs binary, counts binary, grams binary")
    shared = (packed.repartition(parts, "part").groupBy("part")
              .applyInArrow(_counter(parts, crowded is not None), "doc_id long, gram long, df long"))
    return _noded(sigs, crowded), shared


def _needed(n: Column, share: int) -> Column:
    """The least overlap with any similar set: ceil(share * n / 100)."""
    return F.floor((n * share + 99) / 100).cast("long")


def _linked(a: str, b: str, overlap: str, share: int) -> Column:
    return F.col(overlap) * 100 >= share * (F.col(a) + F.col(b) - F.col(overlap))


def _by_cell(grams: Column) -> Column:
    """How many of the grams fall into each cell."""
    cell = F.transform(grams, lambda g: F.pmod(F.shiftrightunsigned(g, 11), F.lit(CELLS)))
    return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.size(F.filter(cell, lambda x: x == c)))


def _all_cells(by_fragment: Column) -> Column:
    """Counts of every cell of every fragment, from a map of those that have any."""
    none = F.array_repeat(F.lit(0), CELLS)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)),
                                 lambda f: F.coalesce(F.element_at(by_fragment, f), none)))


def _overlaps(pairs: DataFrame, segments: DataFrame, cells: bool = False) -> DataFrame:
    """``pairs`` (a, b) with ``overlap``: partial counts per fragment, summed.

    ``cells`` adds the counts of each fragment's cells.
    """
    left = segments.select(F.col("doc_id").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = segments.select(F.col("doc_id").alias("b"), "fragment", F.col("grams").alias("gb"))
    partial = (pairs.join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", "fragment", F.array_intersect("ga", "gb").alias("both")))
    partial = partial.select("a", "b", "fragment", F.size("both").cast("long").alias("part"),
                             *([_by_cell(F.col("both")).alias("counts")] if cells else []))
    found = partial.groupBy("a", "b").agg(F.sum("part").alias("overlap"), *([F.map_from_entries(
        F.collect_list(F.struct("fragment", "counts"))).alias("counts")] if cells else []))
    return found.withColumn("mids", _all_cells(F.col("counts"))).drop("counts") if cells else found


def _overlaps_of_own(able: DataFrame) -> DataFrame:
    """(doc_id, totals): a document's shared shingles in every cell of every fragment."""
    grams = F.transform("order", lambda x: x["gram"])
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)), lambda f: _by_cell(
        F.filter("grams", lambda g: _fragment(g) == f))))
    return able.select("doc_id", grams.alias("grams")).select("doc_id", cells.alias("totals"))


def _fragment(gram: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(gram, 7), F.lit(FRAGMENTS))


def linked_pairs(docs: DataFrame, share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """(classes, links) of ``docs`` (doc_id BIGINT not NULL, text not NULL, mark BIGINT).

    classes: (doc_id, mark, n, rep), a row for each row of ``docs``; rep is the
    smallest node with the same set, NULL for an empty one.  links: (a, b), a > b,
    representatives; enough pairs that every two similar representatives are
    connected through them.
    """
    nodes, shared = _sets(docs)
    reps = nodes.where("n > 0").groupBy("n", "sig1", "sig2").agg(F.min("node").alias("rep"))
    classes = nodes.join(reps, ["n", "sig1", "sig2"], "left").select("doc_id", "mark", "n", "rep")
    lists = (shared.groupBy("doc_id")
             .agg(F.sort_array(F.collect_set(F.struct("df", "gram"))).alias("order")))
    able = reps.select(F.col("rep").alias("doc_id"), "n").join(lists, "doc_id").withColumn(
        "own", F.col("n") - F.size("order")).withColumn(
        "take", F.col("n") - _needed(F.col("n"), share) + 1 - F.col("own"))
    able = pinned(able.where("take > 0"), "shingle-candidates")
    segments = (able.select("doc_id", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)),
        lambda f: F.struct(f.alias("fragment"), F.transform(
            F.filter("order", lambda x: _fragment(x["gram"]) == f),
            lambda x: x["gram"]).alias("grams")))).alias("s"))
        .select("doc_id", "s.fragment", "s.grams").where(F.size("grams") > 0))
    heads = able.select("doc_id", "n", F.size("order").alias("common"), F.explode(F.transform(
        F.slice("order", F.lit(1), F.col("take").cast("int")), lambda x: x["gram"])).alias("gram"))
    # the centre of a bucket: the largest share of shingles that others have too
    centrality = F.struct((F.col("common") / F.col("n")).alias("share"), (-F.col("doc_id")).alias("low"))
    buckets = (heads.groupBy("gram").agg(F.count(F.lit(1)).alias("size"),
                                         F.max_by(F.struct("doc_id", "n"), centrality).alias("centre"))
               .where("size > 1"))
    members = pinned(heads.join(buckets, "gram").select("gram", "doc_id", "n", "common", "size", "centre"),
                     "shingle-buckets")
    close = F.least("na", "nb") * 100 >= share * F.greatest("na", "nb")
    few = members.where(F.col("size") <= SMALL)
    small = (few.select("gram", F.col("doc_id").alias("a"), F.col("n").alias("na"))
             .join(few.select("gram", F.col("doc_id").alias("b"), F.col("n").alias("nb")), "gram")
             .where((F.col("a") > F.col("b")) & close).select("a", "b", "na", "nb"))
    star = (members.where((F.col("size") > SMALL) & (F.col("doc_id") != F.col("centre.doc_id")))
            .select(F.greatest("doc_id", "centre.doc_id").alias("a"), F.least("doc_id", "centre.doc_id").alias("b"),
                    F.when(F.col("doc_id") > F.col("centre.doc_id"), F.col("n")).otherwise(F.col("centre.n")).alias("na"),
                    F.when(F.col("doc_id") > F.col("centre.doc_id"), F.col("centre.n")).otherwise(F.col("n")).alias("nb")))
    star = star.distinct()
    small = small.distinct().join(star.select("a", "b"), ["a", "b"], "left_anti")

    def compared(pairs, cells):
        return _overlaps(pairs.select("a", "b"), segments, cells).join(pairs, ["a", "b"]).withColumn(
            "linked", _linked("na", "nb", "overlap", share))
    no_cells = F.lit(None).cast("array<int>")
    first = pinned(compared(small, False).withColumn("mids", no_cells)
                   .unionByName(compared(star, True)), "shingle-overlaps")

    spokes = (members.where((F.col("size") > SMALL) & (F.col("doc_id") != F.col("centre.doc_id")))
              .select("doc_id", "n", "common", F.col("centre.doc_id").alias("centre")).distinct())
    zeros = F.array_repeat(F.lit(0), FRAGMENTS * CELLS)
    totals = _overlaps_of_own(able)
    known = (spokes.withColumn("a", F.greatest("doc_id", "centre")).withColumn("b", F.least("doc_id", "centre"))
             .join(first.select("a", "b", "mids", "linked"), ["a", "b"], "left").join(totals, "doc_id")
             .withColumn("mids", F.coalesce("mids", zeros))
             .select("centre", "doc_id", "n", "mids",
                     F.zip_with("totals", "mids", lambda t, m: t - m).alias("rests"),
                     F.coalesce("linked", F.lit(False)).alias("linked")))
    known = pinned(known, "shingle-spokes")
    loose = (known.where("NOT linked").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
             .select("centre", "salt", F.col("doc_id").alias("x"), F.col("n").alias("nx"),
                     F.col("mids").alias("mx"), F.col("rests").alias("rx")))
    others = (known.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
              .select("centre", "salt", F.col("doc_id").alias("y"), F.col("n").alias("ny"),
                      F.col("mids").alias("my"), F.col("rests").alias("ry"), "linked"))
    # cell by cell, for what the two lack of the centre is seldom the same
    least = F.zip_with(F.concat("mx", "rx"), F.concat("my", "ry"), lambda x, y: F.least(x, y))
    bound = F.aggregate(least, F.lit(0), lambda t, x: t + x)
    possible = ((F.col("x") != F.col("y")) & (F.col("linked") | (F.col("x") > F.col("y")))
                & (F.least("nx", "ny") * 100 >= share * F.greatest("nx", "ny"))
                & (bound * 100 >= share * (F.col("nx") + F.col("ny") - bound)))
    more = (loose.join(others, (loose["centre"] == others["centre"]) & (loose["salt"] == others["salt"]) & possible)
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"),
                    F.when(F.col("x") > F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"),
                    F.when(F.col("x") > F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb"))
            .distinct().join(first.select("a", "b"), ["a", "b"], "left_anti"))
    more = pinned(more, "shingle-remaining")
    second = (_overlaps(more.select("a", "b"), segments).join(more, ["a", "b"])
              .where(_linked("na", "nb", "overlap", share)))
    links = first.where("linked").select("a", "b").unionByName(second.select("a", "b"))
    return classes, links


def _grouped(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, mark, n, rep, component), one row a row of ``docs`` (doc_id, text).

    ``mark`` hashes the text, a NULL doc_id is NULL_ID, ``component`` is a node, NULL
    for a text without words.
    """
    mark = spare(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    rows = marked.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID).cast("long")).alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col(mark).alias("mark"))
    classes, links = linked_pairs(rows, share)
    near = connected_components(links)
    return (classes.join(near, classes["rep"] == near["node"], "left")
            .select("doc_id", "mark", "n", "rep", F.coalesce("component", "rep").alias("component")))


def components(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row a row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id of the component.  Rows are linked by their
    texts alone: those that repeat a doc_id, or have none, with different texts are
    in one component only if their texts connect them.  A document without words
    has an empty set and is its own component; a NULL text counts as empty.  A NULL
    doc_id sorts first; its component_id is NULL if it is the smallest.  Extra
    columns are dropped.
    """
    found = pinned(_grouped(docs, share), "shingle-groups")
    lowest = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    # nodes are doc_ids unless some were named by their sets: seldom is there one to rename
    lowest = lowest.where("lowest <> component").withColumnRenamed("component", "of")
    out = found.join(lowest, found["component"] == lowest["of"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "rep",
        F.coalesce("lowest", "component", "doc_id").alias("component_id"))

    def named(c):
        return F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(named("doc_id"), "n_shingles", named("component_id"), named("rep"))


def survivors(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, mark), distinct: of each component the row with the smallest doc_id.

    ``mark`` is xxhash64 of the text and decides among equal doc_ids; a NULL doc_id
    is NULL_ID.  Every text without a word survives.
    """
    found = pinned(_grouped(docs, share).select("doc_id", "mark", "component"), "shingle-groups")
    first = (found.where("component IS NOT NULL").groupBy("component")
             .agg(F.min(F.struct("doc_id", "mark")).alias("kept")).select("kept.doc_id", "kept.mark"))
    return first.unionByName(found.where("component IS NULL").select("doc_id", "mark")).distinct()


def op8_ngram_jaccard_components(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    return components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
