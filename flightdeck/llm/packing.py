"""Best-fit packing of token pieces by a grouping genetic algorithm.

Documents are tokenized once; a document longer than a sequence is cut into full
pieces and a rest.  Pieces are dealt by hash to problems of about ``PROBLEM``
pieces; every problem is solved on several islands, each a task of its own with its
own seed.  An individual is a grouping of the pieces into sequences.  Crossover
injects well-filled whole sequences of one parent into another, dissolves the
sequences that now hold a piece twice, and best-fits the displaced pieces, longest
first.  After an epoch each island sends its elite to the next one, as rows; after
the last epoch the problem's best individual is kept.  A group's size is fixed by
``PROBLEM``, not by the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightdeck.llm import tokenization
from flightdeck.llm.common import give_back, id_text, pinned

CAPACITY = 2048
#: Pieces in one packing problem, islands a problem, epochs between migrations.
PROBLEM, ISLANDS, EPOCHS = 12_000, 3, 2
POPULATION, OFFSPRING = 5, 8

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, kind: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenization.encoder(path, kind)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for i, j in tokenization.slices(texts):
                ids, ends = enc.encode(texts.slice(i, j - i))
                ids = ids.astype("<u4")
                rows, begin = [], 0
                for key, stop in zip(keys[i:j], ends.tolist(), strict=True):
                    for n, a in enumerate(range(begin, stop, capacity)):
                        b = min(a + capacity, stop)
                        rows.append((key, n, a - begin, b - a, zlib.crc32(ids[a:b].tobytes())))
                    begin = stop
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                           pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
                del ids, ends, rows, cols
        # the pieces of a partition are met again within it, mostly; kept, they would count
        # against the executor in each worker that waits
        enc.forget()
        give_back()
    return cut


def pieces(docs: DataFrame, vocabulary: str, kind: str = "word", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a row per piece; no shuffle.

    A NULL or empty text is its end id alone; a NULL doc_id stays NULL; repeated
    rows are pieces of their own.
    """
    return id_text(docs).mapInArrow(_cutter(vocabulary, kind, capacity), PIECES)


class _Fitter:
    """Sequences by free room; finds the fullest one that a piece still fits."""

    def __init__(self, capacity: int):
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, seq: int, room: int):
        self.rooms[room].append(seq)
        self.mask |= 1 << room

    def place(self, length: int) -> tuple[int, int] | None:
        fit = self.mask >> length
        if not fit:
            return None
        room = length + (fit & -fit).bit_length() - 1
        seq = self.rooms[room].pop()
        if not self.rooms[room]:
            self.mask &= ~(1 << room)
        self.add(seq, room - length)
        return seq, room - length


def best_fit(lengths: np.ndarray, todo: np.ndarray, seq_of: np.ndarray, rooms: dict[int, int],
             capacity: int) -> np.ndarray:
    """Put the pieces ``todo`` (in that order) into sequences with room, or new ones."""
    fitter = _Fitter(capacity)
    for seq, room in rooms.items():
        fitter.add(seq, room)
    fresh = int(seq_of.max(initial=-1)) + 1
    fresh = max(fresh, max(rooms, default=-1) + 1)
    for i in todo.tolist():
        n = int(lengths[i])
        got = fitter.place(n)
        if got is None:
            seq_of[i] = fresh
            fitter.add(fresh, capacity - n)
            fresh += 1
        else:
            seq_of[i] = got[0]
    return seq_of


def _compact(seq_of: np.ndarray) -> np.ndarray:
    return np.unique(seq_of, return_inverse=True)[1].astype(np.int64)


def fitness(lengths: np.ndarray, seq_of: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the more uneven (squared) filling."""
    fill = np.bincount(seq_of, lengths)
    return -len(fill), float(((fill / capacity) ** 2).sum())


def crossover(lengths, mother, father, capacity, rng) -> np.ndarray:
    """Inject well-filled sequences of ``father`` into ``mother`` and repair."""
    fill = np.bincount(father, lengths)
    # the fuller a sequence, the likelier it is injected
    chance = np.where(fill >= 0.99 * capacity, 0.5, 0.5 * (fill / capacity) ** 16)
    inject = rng.random(len(fill)) < chance
    moved = inject[father]
    broken = np.zeros(int(mother.max()) + 1, bool)
    broken[mother[moved]] = True
    displaced = np.flatnonzero(broken[mother] & ~moved)
    child = mother.copy()
    child[moved] = father[moved] + len(broken)
    child[displaced] = -1
    kept = child >= 0
    left = np.bincount(child[kept], lengths[kept], len(broken) + len(fill)).astype(np.int64)
    rooms = {int(s): int(capacity - left[s]) for s in np.flatnonzero(left) if left[s] < capacity}
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return _compact(best_fit(lengths, order, child, rooms, capacity))


def mutate(lengths, parent, capacity, rng, share: float = 0.05) -> np.ndarray:
    """Dissolve some of the emptier sequences and best-fit their pieces."""
    fill = np.bincount(parent, lengths)
    order = np.argsort(fill, kind="stable")
    drop = np.zeros(len(fill), bool)
    drop[order[:max(1, int(share * len(fill)))]] = True
    drop |= rng.random(len(fill)) < share / 2
    child = parent.copy()
    out = np.flatnonzero(drop[parent])
    child[out] = -1
    rooms = {int(s): int(capacity - fill[s]) for s in np.flatnonzero(~drop) if fill[s] < capacity}
    todo = rng.permutation(out)
    todo = todo[np.argsort(-lengths[todo] + rng.normal(0, 40, len(todo)), kind="stable")]
    return _compact(best_fit(lengths, todo, child, rooms, capacity))


def evolve(lengths: np.ndarray, capacity: int, seed: int, founders: list[np.ndarray],
           population: int = POPULATION, offspring: int = OFFSPRING) -> np.ndarray:
    """The best grouping after one epoch on one island."""
    rng = np.random.default_rng(seed)
    everyone = list(founders)
    if not everyone:
        order = np.argsort(-lengths, kind="stable")
        everyone.append(best_fit(lengths, order, np.full(len(lengths), -1, np.int64), {}, capacity))
    everyone = [_compact(p) for p in everyone]
    while len(everyone) < population:
        everyone.append(mutate(lengths, everyone[0], capacity, rng))
    scored = sorted(((fitness(lengths, p, capacity), i, p) for i, p in enumerate(everyone)), reverse=True)
    least = -(-int(lengths.sum()) // capacity)
    for n in range(offspring):
        if -scored[0][0][0] <= least:
            break  # no grouping can use fewer sequences
        a, b = sorted(rng.choice(len(scored), 2, replace=False))
        child = crossover(lengths, scored[a][2], scored[b][2], capacity, rng)
        if rng.random() < 0.3:
            child = mutate(lengths, child, capacity, rng)
        scored = sorted([*scored[:-1], (fitness(lengths, child, capacity), 10_000 + n, child)], reverse=True)
    return scored[0][2]


_STATE = ("problem long, island int, sequences long, fill double, doc_id array<long>, piece array<int>,"
          " start array<long>, length array<long>, ids_crc32 array<long>, seq array<long>")
_LISTS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _settle(capacity: int, seed: int):
    def run(key, rows):
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                             ("ids_crc32", "ascending")])
        cols = {c: rows.column(c).to_pylist() for c in _LISTS}
        problem, island = key[0].as_py(), key[1].as_py()
        lengths = np.array(cols["length"], np.int64)
        seq = evolve(lengths, capacity, seed + 1009 * problem + island, [])
        return _as_state(problem, island, cols, seq, capacity)
    return run


def _as_state(problem, island, cols, seq, capacity) -> pa.Table:
    n, fill = fitness(np.array(cols["length"], np.int64), seq, capacity)
    return pa.table({
        "problem": pa.array([problem], pa.int64()), "island": pa.array([island], pa.int32()),
        "sequences": pa.array([-n], pa.int64()), "fill": pa.array([fill]),
        "doc_id": pa.array([cols["doc_id"]], pa.list_(pa.int64())),
        "piece": pa.array([cols["piece"]], pa.list_(pa.int32())),
        "start": pa.array([cols["start"]], pa.list_(pa.int64())),
        "length": pa.array([cols["length"]], pa.list_(pa.int64())),
        "ids_crc32": pa.array([cols["ids_crc32"]], pa.list_(pa.int64())),
        "seq": pa.array([seq.tolist()], pa.list_(pa.int64()))})


def _meet(capacity: int, seed: int, epoch: int):
    """One epoch of an island from its own elite and its neighbour's."""
    def run(key, rows):
        found = rows.to_pylist()  # two individuals of one problem
        problem, island = key[0].as_py(), key[1].as_py()
        cols = found[0]
        lengths = np.array(cols["length"], np.int64)
        elites = sorted((np.array(r["seq"], np.int64) for r in found),
                        key=lambda p: fitness(lengths, p, capacity), reverse=True)
        seq = evolve(lengths, capacity, seed + 7919 * epoch + 1009 * problem + island, elites)
        return _as_state(problem, island, cols, seq, capacity)
    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            seq = np.array(row["seq"], np.int64)
            lengths = np.array(row["length"], np.int64)
            order = np.argsort(seq, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.searchsorted(seq[order], np.arange(len(order) and int(seq.max()) + 1))
            offset = np.empty(len(order), np.int64)
            offset[order] = before - before[first][seq[order]] if len(order) else before
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["piece"], pa.int32()),
                 pa.array(row["start"], pa.int64()), pa.array(row["length"], pa.int64()),
                 pa.array(row["ids_crc32"], pa.int64()),
                 pa.array((row["problem"] << 32) + seq, pa.int64()), pa.array(offset, pa.int64())],
                names=[*_LISTS, "sequence_id", "offset"])


def dealt(rows: DataFrame, problem_pieces: int = PROBLEM) -> DataFrame:
    """``rows`` with ``problem``, each of about ``problem_pieces`` pieces.

    Rows are numbered as they are stored, and the number is part of the hash, so equal
    rows (one doc_id on a third of the table) spread like any others; read back, a
    number never changes, whatever task is run again.
    """
    held = pinned(rows.withColumn("row_number", F.monotonically_increasing_id()), "pieces")
    problems = max(1, -(-held.count() // problem_pieces))
    problem = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row_number"), F.lit(problems))
    return held.withColumn("problem", problem).drop("row_number")


def pack(rows: DataFrame, capacity: int = CAPACITY, seed: int = 7, problem_pieces: int = PROBLEM,
         islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Pack ``rows`` (the columns of PIECES, length <= capacity): adds sequence_id, offset.

    Pieces of equal length are interchangeable, so ties are broken by doc_id and
    piece.  NULL doc_ids and repeated rows are packed like any other; an empty
    table gives an empty result.
    """
    each = dealt(rows, problem_pieces).withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    elites = pinned(each.groupBy("problem", "island").applyInArrow(_settle(capacity, seed), _STATE), "packing")
    for epoch in range(1, epochs):
        guests = elites.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int"))
        elites = pinned(elites.unionByName(guests).groupBy("problem", "island")
                        .applyInArrow(_meet(capacity, seed, epoch), _STATE), "packing")
    best = elites.groupBy("problem").agg(
        F.max_by("island", F.struct(-F.col("sequences"), "fill", -F.col("island"))).alias("island"))
    return (elites.join(best, ["problem", "island"], "left_semi")
            .mapInArrow(_placed, f"{PIECES}, sequence_id long, offset long"))


def packed_documents(docs: DataFrame, vocabulary: str, kind: str = "word", capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row a piece."""
    return pack(pieces(docs, vocabulary, kind, capacity), capacity)


def op5_genetic_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from flightdeck.llm.common import documents
    return packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
