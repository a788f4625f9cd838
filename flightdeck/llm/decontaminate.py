"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edits.

Texts are read as words (runs of letters, digits and non-ASCII characters, A-Z
lower-cased).  A passage is found where some stretch of a document is within
floor(EDITS * words) word insertions, deletions and substitutions of the item.

An item of more than PIECE words is looked for by pieces of at most PIECE: of a match
within the limit some piece is within its own limit, for the edits are shared out
among them.  So the signatures needed do not grow with the item's length.

Windows have the size of the pieces, one at every word.  A window and a piece become
longer symbol strings by a random walk that repeats or advances; strings within few edits then agree in most places.  WALKS walks with
TABLES samples of PLACES places each give signatures; an equal one makes a
candidate, and an edit-distance table of the whole item decides it.  A window is only
embedded if it holds as many of the pieces' word triples as a match must leave whole
(a match of k edits breaks at most 3 k), and the table is only filled where the whole
item's triples allow a match, so no match is lost but by the signatures.

Items are a stated query set: they go to the tasks in blocks of at most
BLOCK_WORDS words, one scan of the documents for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightdeck.llm.common import give_back, id_text
from flightdeck.llm.jaccard_join import word_hashes
from flightdeck.llm.tokenization import slices

EDITS = 0.15
WALKS, TABLES, PLACES = 8, 8, 4
#: Words of a piece: for longer strings the signatures would miss matches.
PIECE = 40
BLOCK_WORDS = 200_000
_PAD = np.uint64(0x5851F42D4C957F2D)
_R = np.uint64(0x9E3779B97F4A7C15)

# bytes that part words: ASCII but letters and digits
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, text number) of the texts' words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends, _MARKS)


def allowed(n: int, edits: float = EDITS) -> int:
    return int(edits * n)


def grams(words: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` words from each place on."""
    h = np.zeros(max(len(words) - q + 1, 0), np.uint64)
    for j in range(q):
        h = _mix(h * _R + words[j:j + len(h)])
    return h


def signatures(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """LSH keys, (windows, WALKS * TABLES), of the windows of ``n`` words at ``starts``."""
    rng = np.random.default_rng(1000 + n)
    length = 2 * n  # the last third of the walk mostly repeats the padding
    turns = rng.integers(1, 1 << 63, (length, WALKS), dtype=np.uint64) | np.uint64(1)
    # which signatures sample which place of their walk
    drawn = np.zeros((length, WALKS * TABLES), bool)
    for c in range(WALKS * TABLES):
        drawn[rng.choice(length, min(PLACES, length), replace=False), c] = True
    out = np.zeros((len(starts), WALKS * TABLES), np.uint64)
    i = np.zeros((len(starts), WALKS), np.int64)
    for j in range(length):
        symbol = np.where(i < n, words[starts[:, None] + np.minimum(i, n - 1)], _PAD)
        at = np.flatnonzero(drawn[j])
        if len(at):
            out[:, at] = _mix(out[:, at] * _R + symbol[:, at // TABLES] + np.uint64(j))
        i += (_mix(symbol * turns[j]) >> np.uint64(63)).astype(np.int64)
    return out


@dataclass
class Block:
    """Items of one block, ready to be looked up."""
    ids: list
    words: list[np.ndarray]
    #: per piece length: sorted signature keys per table, and the pieces they name
    tables: dict[int, list[tuple[np.ndarray, np.ndarray]]]
    #: per piece: its item, and the place of its first word there
    pieces: list[tuple[int, int]]
    #: per gram size: sorted hashes of the pieces' grams, and a bitmap over them
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    #: per piece length: sorted hashes of the grams of the pieces of that length
    own_grams: dict[int, np.ndarray]


def prepared(items: list[tuple[int, str]]) -> Block:
    """Signature tables and gram sets; items without a word are left out."""
    ids, words = [], []
    for key, text in items:
        w = words_of([text])[0]
        if len(w):
            ids.append(key)
            words.append(w)
    by_length: dict[int, list[int]] = {}
    pieces, parts = [], []
    for n, w in enumerate(words):
        count = -(-len(w) // PIECE)
        cut = [len(w) * i // count for i in range(count + 1)]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            by_length.setdefault(b - a, []).append(len(pieces))
            pieces.append((n, a))
            parts.append(w[a:b])
    tables, found, own = {}, {}, {}
    for length, members in by_length.items():
        keys = signatures(np.concatenate([parts[m] for m in members]),
                          np.arange(len(members)) * length, length)
        named = np.array(members)
        tables[length] = []
        for c in range(keys.shape[1]):
            order = np.argsort(keys[:, c], kind="stable")
            tables[length].append((keys[order, c], named[order]))
        own[length] = np.unique(np.concatenate([grams(parts[m], min(3, length)) for m in members]))
        found.setdefault(min(3, length), []).append(own[length])
    sets = {}
    for q, of_lengths in found.items():
        all_grams = np.unique(np.concatenate(of_lengths))
        bitmap = np.zeros(1 << 20, bool)
        bitmap[(all_grams >> np.uint64(44)).astype(np.int64)] = True
        sets[q] = (all_grams, bitmap)
    return Block(ids, words, tables, pieces, sets, own)


def _known(h: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    hit = known[1][(h >> np.uint64(44)).astype(np.int64)]
    at = np.flatnonzero(hit)
    place = np.searchsorted(known[0], h[at])
    hit[at] = known[0][np.minimum(place, len(known[0]) - 1)] == h[at]
    return hit


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, stop) of the stretch of ``text`` closest to ``item``.

    An edit table with a free start and end in the text; of equal distances the
    stretch that ends first, then starts last, is taken.
    """
    m = len(text)
    cost = np.zeros(m + 1, np.int64)
    begin = np.arange(m + 1)
    step = np.arange(m + 1)
    for n, word in enumerate(item.tolist()):
        diagonal = cost[:-1] + (text != np.uint64(word))
        down = cost + 1
        new, origin = down.copy(), begin.copy()
        better = diagonal <= new[1:]
        new[1:] = np.where(better, diagonal, new[1:])
        origin[1:] = np.where(better, begin[:-1], origin[1:])
        # insertions run along the row: a running minimum of cost minus place
        level = new - step
        low = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == low, step, 0))
        cost, begin = low + step, origin[source]
    stop = int(np.argmin(cost))
    return int(cost[stop]), int(begin[stop]), stop


def _runs_of(texts: list[str], budget: int = 1 << 20) -> Iterator[slice]:
    """Slices of about a million characters: their arrays stay in the cache."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size > budget:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or "")
    if start < len(texts):
        yield slice(start, len(texts))


def _rich(texts: list[str], first: int, block: Block, least: dict[int, int]):
    """(words, text numbers, gram hits) of the texts that could hold some item."""
    words, doc = words_of(texts)
    hits = {}
    rich = np.zeros(len(texts), bool)
    for q, known in block.grams.items():
        h = grams(words, q)
        hits[q] = np.zeros(len(words), bool)
        if len(h):
            hits[q][:len(h)] = _known(h, known) & (doc[:len(h)] == doc[q - 1:q - 1 + len(h)])
        need = min(v for n, v in least.items() if min(3, n) == q)
        rich |= np.bincount(doc, hits[q], len(texts)) >= need
    kept = np.flatnonzero(rich[doc])
    return words[kept], doc[kept] + first, {q: hit[kept] for q, hit in hits.items()}


def matches(texts: list[str], block: Block, edits: float = EDITS) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, first word, stop word, distance) of every passage."""
    if not block.ids:
        return []
    least = {n: n - min(3, n) + 1 - min(3, n) * allowed(n, edits) for n in block.tables}
    pooled = []
    for i in _runs_of(texts):
        pooled.append(_rich(texts[i], i.start, block, least))
    words, doc = (np.concatenate([p[c] for p in pooled]) for c in (0, 1)) if pooled else ([], [])
    if not len(words):
        return []
    hits = {q: np.concatenate([p[2][q] for p in pooled]) for q in block.grams}
    moved = np.searchsorted(doc, np.arange(len(texts)))
    met = {q: np.flatnonzero(hit) for q, hit in hits.items()}
    # the pooled words of a text stand together, so their grams are as before
    named_grams = {q: grams(words, q)[at] for q, at in met.items()}
    ends = np.searchsorted(doc, np.arange(len(texts)), "right")
    pairs: dict[tuple[int, int], set[int]] = {}
    for n, tables in block.tables.items():
        if n > len(words):
            continue
        q = min(3, n)
        start = np.arange(len(words) - n + 1)
        own = np.zeros(len(words) + 1, np.int64)
        own[met[q] + 1] = np.isin(named_grams[q], block.own_grams[n])
        sums = np.cumsum(own)
        enough = sums[start + n - q + 1] - sums[start] >= least[n]
        start = np.flatnonzero(enough & (doc[:len(start)] == doc[n - 1:]))
        if not len(start):
            continue
        keys = signatures(words, start, n)
        for c, (sorted_keys, named) in enumerate(tables):
            lo = np.searchsorted(sorted_keys, keys[:, c], "left")
            hi = np.searchsorted(sorted_keys, keys[:, c], "right")
            for at in np.flatnonzero(hi > lo).tolist():
                s = int(start[at])
                for piece in named[lo[at]:hi[at]].tolist():
                    item, offset = block.pieces[piece]
                    pairs.setdefault((int(doc[s]), item), set()).add(s - offset)
    out = []
    whole: dict[int, np.ndarray] = {}
    for (text, item), places in pairs.items():
        wanted = block.words[item]
        n, k = len(wanted), allowed(len(wanted), edits)
        places = sorted(places)
        q = min(3, n)
        need = n - q + 1 - q * k
        if item not in whole:
            whole[item] = np.unique(grams(wanted, q))
        group = [places[0], places[0]]
        groups = [group]
        for s in places[1:]:
            if s <= group[1] + n:
                group[1] = s
            else:
                group = [s, s]
                groups.append(group)
        for a, b in groups:
            # a stretch may hold several copies of an item: look left and right of each
            todo = [(max(int(moved[text]), a - n), min(int(ends[text]), b + 2 * n))]
            while todo:
                lo, hi = todo.pop()
                if hi - lo < n - k or (need > 0 and np.isin(grams(words[lo:hi], q), whole[item]).sum() < need):
                    continue
                distance, x, y = best_stretch(wanted, words[lo:hi])
                if distance <= k:
                    base = int(moved[text])
                    out.append((text, item, lo + x - base, lo + y - base, distance))
                    todo += [(lo, lo + x), (lo + y, hi)]
    return sorted(set(out))


def _finder(shared, edits: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            text, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            found = matches(text.to_pylist(), block, edits)
            if found:
                t, item, a, b, d = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[x] for x in t], pa.int64()),
                     pa.array([block.ids[x] for x in item], pa.int64()),
                     pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int64())],
                    names=["doc_id", "item_id", "first_word", "stop_word", "distance"])
    return find


def _marker(shared, edits: float):
    def clean(text: pa.Array) -> pa.Array:
        leaked = np.zeros(len(text), bool)
        # a few megabytes at a time, for words are wider than their text
        for i, j in slices(text, 4 << 20):
            for x in matches(text.slice(i, j - i).to_pylist(), shared.value, edits):
                leaked[i + x[0]] = True
        give_back()
        return pa.array(~leaked)
    return clean


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items (item_id, text), prepared block by block; one block is on the driver."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    words = rows.agg(F.sum(F.size(F.split("text", " "))).alias("n")).first()["n"] or 0
    blocks = -(-words // block_words)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        got = sorted(((r["item_id"], r["text"]) for r in rows.where(place == b).collect()),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield prepared(got)


def contaminated(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, first_word, stop_word, distance): a row per passage found.

    Word places count from 0, stop excluded.  NULL and empty texts and items match
    nothing; NULL ids stay NULL; repeated rows and items give rows of their own;
    extra columns are dropped; without items or documents the result is empty.
    """
    rows, out = id_text(docs), None
    schema = "doc_id long, item_id long, first_word long, stop_word long, distance long"
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_WORDS words
        found = rows.mapInArrow(_finder(shared, edits), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", edits: float = EDITS) -> DataFrame:
    """The rows of ``docs`` in which no item is found; columns as they are.

    Only the text goes to Python, once a block of items, and only a flag comes back.
    """
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        clean = F.arrow_udf(_marker(shared, edits), T.BooleanType()).asNondeterministic()
        docs = docs.where(clean(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return docs


def op7_benchmark_passages(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
