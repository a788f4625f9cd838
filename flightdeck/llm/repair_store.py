"""Token-id files compressed by Re-Pair, with random access to any document.

Documents are range-partitioned and sorted by doc_id; each partition is cut into
shards of whole documents.  Within a shard the frequent pairs of ids are replaced
by nonterminals, round after round, and the grammar, the expansion length of every
rule and the compressed sequence become one row of a Parquet file.  Bounded
memory: a shard holds at most ``shard_tokens`` ids unless one document is longer.

File format, one row per shard:
  part, shard          position: shards ascend by (part, shard) as doc_ids do
  start_in_part        ids of the partition that stand before the shard
  n_tokens             ids in the shard
  doc_ids, doc_tokens  per document, in order: id, number of ids (end id included)
  doc_offsets          where each document starts in ``sequence``
  n_terminals          symbols below it are ids (the end id is kept as END)
  rules                little-endian uint32 pairs; rule r is symbol n_terminals + r
  rule_lengths         little-endian uint32: how many ids a rule expands to
  sequence             the compressed sequence, little-endian, ``width`` bytes a symbol
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightdeck.llm import tokenization
from flightdeck.llm.common import id_text, parts_for, text_bytes
from flightdeck.session import scratch_path

FILE_SCHEMA = ("part int, shard int, start_in_part long, n_tokens long, doc_ids array<long>,"
               " doc_tokens array<long>, doc_offsets array<long>, n_terminals int, rules binary,"
               " rule_lengths binary, sequence binary, width int")
_FILE = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("start_in_part", pa.int64()),
                   ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                   ("doc_tokens", pa.list_(pa.int64())), ("doc_offsets", pa.list_(pa.int64())),
                   ("n_terminals", pa.int32()), ("rules", pa.binary()),
                   ("rule_lengths", pa.binary()), ("sequence", pa.binary()), ("width", pa.int32())])


def _frequent(left: np.ndarray, right: np.ndarray, n_symbols: int,
              least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, places) of the pairs that occur ``least`` times or more.

    Pairs are left << 32 | right, ascending; the places of each pair follow one another.
    Where a pair and its place fit 63 bits together, plain values are sorted, which
    is several times faster than an order of places.
    """
    bits, room = max(n_symbols - 1, 1).bit_length(), max(len(left), 1).bit_length()
    if 2 * bits + room <= 63:
        both = np.sort((((left << bits) | right) << room) | np.arange(len(left)))
        place, both = both & ((1 << room) - 1), both >> room
    else:
        bits = 32
        both = (left << bits) | right
        place = np.argsort(both, kind="stable")
        both = both[place]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[:len(both)])
    count = np.diff(np.append(first, len(both)))
    often = count >= least
    pairs = both[first[often]]
    return (((pairs >> bits) << 32) | (pairs & ((1 << bits) - 1)), count[often], place[np.repeat(often, count)])


def compress(seq: np.ndarray, end: int, n_terminals: int,
             least: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, rules, rule_lengths) of one shard; ``end`` joins no pair.

    A round ranks the pairs that occur at least ``least`` times by count and
    replaces an occurrence when no overlapping one ranks better (of equal ones every
    other), so many pairs are replaced in one vectorised pass.  Rounds end when
    no pair is left that occurs so often.  A pair once found rarer stays so, for
    places are only ever taken from it: after the first round only places of frequent
    pairs and places beside a new symbol are counted.
    """
    # symbols number at most twice the ids: four bytes hold them
    seq = seq.astype(np.int32)
    rules = np.zeros((0, 2), np.int64)
    lengths = np.zeros(0, np.int64)
    open_at = np.arange(max(len(seq) - 1, 0))  # places whose pair may be frequent
    while len(open_at):
        left, right = seq[open_at].astype(np.int64), seq[open_at + 1].astype(np.int64)
        inner = (left != end) & (right != end)
        open_at = open_at[inner]
        pairs, count, place = _frequent(left[inner], right[inner], n_terminals + len(rules), least)
        if not len(pairs):
            break
        none = np.iinfo(np.int32).max  # the rank of a pair that is not replaced
        by_rank = np.lexsort((pairs, -count))
        rank_of = np.empty(len(pairs), np.int32)
        rank_of[by_rank] = np.arange(len(pairs))
        own = np.full(len(open_at), none, np.int32)
        own[place] = np.repeat(rank_of, count)
        own, open_at = own[own < none], open_at[own < none]
        rank = np.full(len(seq) + 1, none, np.int32)
        rank[open_at + 1] = own
        taken = []
        for _ in range(2):  # once more among what the first choice leaves free
            mid = rank[open_at + 1]
            best = (mid <= rank[open_at]) & (mid <= rank[open_at + 2]) & (mid < none)
            got, mid = open_at[best], mid[best]
            # neighbours have equal ranks (one symbol over and over): every other one
            head = np.concatenate([[True], np.diff(got) != 1])[:len(got)]
            inner = np.arange(len(got)) - np.maximum.accumulate(np.where(head, np.arange(len(got)), 0))
            even = inner % 2 == 0
            got = got[even]
            taken.append((got, mid[even]))
            for step in (0, 1, 2):  # rank is shifted by one: left, own and right place
                rank[got + step] = none
        take, chose = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(take, kind="stable")
        take, chose = take[order], chose[order]
        hit = np.zeros(len(pairs), bool)
        hit[chose] = True
        used, fresh = np.flatnonzero(hit), (np.cumsum(hit) - 1)[chose]
        symbol = n_terminals + len(rules)
        chosen = pairs[by_rank[used]]
        new = np.stack([chosen >> 32, chosen & 0xFFFFFFFF], 1)
        size = np.concatenate([np.ones(n_terminals, np.int64), lengths])
        lengths = np.concatenate([lengths, size[new[:, 0]] + size[new[:, 1]]])
        rules = np.concatenate([rules, new])
        seq[take] = symbol + fresh
        hope = np.zeros(len(seq) + 1, bool)  # shifted by one, like rank
        hope[open_at + 1] = True
        hope[take] = hope[take + 1] = True
        stay = np.ones(len(seq), bool)
        stay[take + 1] = False
        seq, hope = seq[stay], hope[1:][stay]
        open_at = np.flatnonzero(hope[:-1])
    return seq.astype(np.int64), rules, lengths


def expand(seq: np.ndarray, rules: np.ndarray, n_terminals: int) -> np.ndarray:
    """The ids that a compressed sequence stands for."""
    while len(seq):
        deep = seq >= n_terminals
        if not deep.any():
            break
        n = 1 + deep.astype(np.int64)
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int64)
        out[at] = seq
        pair = rules[seq[deep] - n_terminals]
        out[at[deep]], out[at[deep] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def expand_all(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray, n_terminals: int,
               most: int = 64) -> np.ndarray:
    """``expand`` for a whole sequence: what symbols of at most ``most`` ids stand for is
    spelt once, longer symbols are first replaced by their pairs."""
    size = np.concatenate([np.ones(n_terminals, np.int64), lengths])
    while True:
        deep = size[seq] > most
        if not deep.any():
            break
        at = np.arange(len(seq)) + np.cumsum(deep) - deep
        out = np.empty(len(seq) + int(deep.sum()), seq.dtype)
        out[at] = seq
        pair = rules[seq[deep] - n_terminals]
        out[at[deep]], out[at[deep] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    short = np.flatnonzero(lengths <= most)
    spelt = np.concatenate([np.arange(n_terminals), expand(short + n_terminals, rules, n_terminals)]).astype(np.int32)
    begin = np.zeros(len(size), np.int64)
    begin[:n_terminals] = np.arange(n_terminals)
    begin[short + n_terminals] = n_terminals + np.cumsum(lengths[short]) - lengths[short]
    n = size[seq]
    after = np.cumsum(n)
    at = np.repeat((begin[seq] - after + n).astype(np.int32), n)
    at += np.arange(len(at), dtype=np.int32)
    return spelt[at]


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    seq = np.frombuffer(row["sequence"], f"<u{row['width']}").astype(np.int64)
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    return seq, rules, np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)


def read_ids(row: dict, doc: int, lo: int = 0, hi: int | None = None, end_id: int = 0) -> np.ndarray:
    """ids ``lo:hi`` of the ``doc``-th document of a shard row.

    Rule lengths locate the symbols that cover the range; only those expand.
    """
    seq, rules, lengths = _unpack(row)
    base = row["n_terminals"]
    cut = [*row["doc_offsets"], len(seq)]
    seq = seq[cut[doc]:cut[doc + 1]]
    size = np.concatenate([np.ones(base, np.int64), lengths])[seq]
    after = np.cumsum(size)
    hi = int(row["doc_tokens"][doc]) if hi is None else min(hi, int(row["doc_tokens"][doc]))
    if lo >= hi:
        return np.zeros(0, np.int64)
    a, b = np.searchsorted(after, lo, "right"), np.searchsorted(after, hi, "left") + 1
    ids = expand(seq[a:b], rules, base)
    first = lo - int(after[a] - size[a])
    ids = ids[first:first + hi - lo]
    return np.where(ids == base - 1, end_id, ids)


def _shard_row(part, shard, before, ids, docs, counts, n_vocab):
    """One file row; symbol ``n_vocab`` stands for the end id between documents."""
    seq = ids.astype(np.int64)
    ends = np.cumsum(counts)
    seq[ends - 1] = n_vocab
    seq, rules, lengths = compress(seq, n_vocab, n_vocab + 1)
    closes = np.flatnonzero(seq == n_vocab)
    width = 2 if n_vocab + 1 + len(rules) <= 1 << 16 else 4
    return {"part": part, "shard": shard, "start_in_part": before, "n_tokens": int(ends[-1]),
            "doc_ids": docs, "doc_tokens": counts.tolist(),
            "doc_offsets": [0, *(closes[:-1] + 1).tolist()], "n_terminals": n_vocab + 1,
            "rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(),
            "sequence": seq.astype(f"<u{width}").tobytes(), "width": width}


def _writer(path: str, kind: str, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenization.encoder(path, kind)
        vocab = enc.tokenizer.get_vocab_size()
        part = TaskContext.get().partitionId()
        ids, docs, counts, held, shard, before = [], [], [], 0, 0, 0

        def flush():
            row = _shard_row(part, shard, before, np.concatenate(ids), docs, np.array(counts), vocab)
            return pa.RecordBatch.from_pylist([row], schema=_FILE)

        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for i, j in tokenization.slices(texts):
                got, ends = enc.encode(texts.slice(i, j - i))
                begin = 0
                for key, stop in zip(keys[i:j], ends.tolist(), strict=True):
                    if held and held + stop - begin > shard_tokens:
                        yield flush()
                        before, shard = before + held, shard + 1
                        ids, docs, counts, held = [], [], [], 0
                    ids.append(got[begin:stop])
                    docs.append(key)
                    counts.append(stop - begin)
                    held += stop - begin
                    begin = stop
        if held:
            yield flush()
    return write


def write_ids(docs: DataFrame, out: str, vocabulary: str, kind: str = "byte",
              shard_tokens: int = 1 << 18, bytes_per_part: int = 24 << 20) -> None:
    """Encode ``docs`` (doc_id, text) and write the shard files under ``out``.

    One shuffle, of the texts by doc_id range; equal doc_ids stay together (order
    among them is free), NULL doc_ids come first, a NULL or empty text is its end
    id alone, extra columns are dropped, an empty table writes no shard.
    """
    base = id_text(docs)
    parts = parts_for(text_bytes(base), bytes_per_part, 12)
    (base.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(_writer(vocabulary, kind, shard_tokens), FILE_SCHEMA)
     .write.parquet(out))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            seq, rules, lengths = _unpack(row)
            base = row["n_terminals"]
            ids = expand_all(seq, rules, lengths, base)
            ids[ids == base - 1] = 0
            ids = ids.astype("<u4", copy=False)
            ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
            first = row["part_start"] + row["start_in_part"]
            begins = ends - np.array(row["doc_tokens"], np.int64)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(first + begins, pa.int64()),
                 pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64()),
                 pa.array([len(seq)] * len(crc), pa.int64()), pa.array([row["n_tokens"]] * len(crc), pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "shard_symbols", "shard_tokens"])


def read_documents(spark, path: str) -> DataFrame:
    """Decode every shard: (doc_id, start, n_tokens, ids_crc32, shard_symbols, shard_tokens).

    Only the totals per partition (one row for each) are summed in order and
    broadcast; their number is the partition count that ``write_ids`` set.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    return (files.join(F.broadcast(starts), "part")
            .mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long,"
                                 " shard_symbols long, shard_tokens long"))


def op2_repair_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from flightdeck.llm.common import documents
    out = scratch_path(spark, "token-ids")
    write_ids(documents(spark, sf_dir), out, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, out)
