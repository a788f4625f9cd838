"""Duplicate-substring removal by prefix-free parsing.

Texts are UTF-8 bytes.  Every string of SPAN bytes holds a trigger: the k-mer whose
rolling hash is the least of the string's k-mers (the leftmost of equals).  The
strings of a text that share a trigger are consecutive; together they form a phrase
of the parse.  The trigger is part of each phrase and chosen from the phrase's bytes
alone, so equal strings in different texts have equal triggers at equal distance,
whatever surrounds them.

1. One shuffle carries the parse, packed by trigger hash: per document and
   partition the phrases in text order as (trigger hash, phrase hash).
2. A partition is a part of the dictionary: of equal phrases those in the smallest
   doc_id are kept; the later ones are wholly duplicate.  A trigger with a single
   phrase needs nothing more.  Of a trigger with several phrases, the kept ones are
   asked for: they may share strings without being equal.
3. Documents join with what concerns them and send the bytes of the phrases that
   were asked for.
4. Within a trigger, the suffixes of the asked phrases that are SPAN bytes long are
   put in order (dictionary order by trigger, distance and hash); in a run of equal
   ones all but those of the smallest doc_id are duplicate.  Of a trigger with more
   than HOT phrases no bytes are sent but the hash of every string, dealt by that
   hash over all partitions, so its strings never meet in one task.
5. Documents join with their duplicate intervals and are cut.

Copied text costs one dictionary phrase, so repetitive corpora shrink at step 2.
A passage in many documents is one phrase entry for each and spreads over as many
partitions as it has triggers.  A frequent trigger whose neighbourhood is new each time has one
phrase for each occurrence in step 4; those are spread string by string.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightdeck.llm import tokenization
from flightdeck.llm.common import NULL_ID, id_text, parts_for, pinned, text_bytes

SPAN = 50
#: Bytes of a trigger: shorter ones are fewer but recur by chance.
TRIGGER = 20
#: Text bytes for each part of the dictionary.
BYTES_PER_PART = 12 << 20
#: Phrases of a trigger that are put in order together.
HOT = 4096
#: Bytes parsed at once (positions must fit 24 bits; their arrays stay in a core's
#: cache), packed together and answered together.
CHUNK, PACKED, ANSWERED = 1 << 16, 8 << 20, 4 << 20

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * _R)


def _power(base: np.uint64, n: int) -> np.ndarray:
    """Powers 0 to ``n`` of ``base``; those of a chunk are kept."""
    if n <= CHUNK:
        return _power_of_chunk(int(base))[:n + 1]
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]), dtype=np.uint64)


@functools.lru_cache(2)
def _power_of_chunk(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(CHUNK, base, np.uint64)]), dtype=np.uint64)


class Rolling:
    """Hashes of any stretch of a byte buffer, equal for equal bytes anywhere."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODE[data] * _power(_R, len(data))[:-1], out=self.sums[1:])
        # brings a stretch back to power 0, wherever it stands
        self.back = _power(_R_INVERSE, len(data))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.sums[stop] - self.sums[start]) * self.back[start]
        return _mix(raw + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def every(self, k: int) -> np.ndarray:
        """:meth:`of` for all stretches of ``k`` bytes, by start."""
        raw = self.sums[k:] - self.sums[:-k]
        raw *= self.back[:len(raw)]
        raw += np.uint64(k * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        return _mix(raw)


def parse(data: np.ndarray, ends: np.ndarray, span: int = SPAN, k: int = TRIGGER) -> dict[str, np.ndarray]:
    """Phrases of concatenated texts: doc, first, last, trigger place, hashes.

    ``first`` and ``last`` bound the starts of the strings (of ``span`` bytes) that
    share the trigger at ``at``; texts shorter than ``span`` have no phrase.
    """
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < span:
        return {c: empty for c in ("doc", "first", "last", "at")} | {
            c: empty.astype(np.uint64) for c in ("trigger", "phrase")} | {"rolling": Rolling(data)}
    roll = Rolling(data)
    kmer = roll.every(k)
    # order by hash, then by place: the low 24 bits hold the place
    key = kmer & ~np.uint64(0xFFFFFF)
    key |= np.arange(len(kmer), dtype=np.uint64)
    width, least, have = span - k + 1, key, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:len(key) - width + 1], least[width - have:width - have + len(key) - width + 1])
    # a phrase ends where the trigger changes, where a text begins, and where its
    # last string has begun
    edge = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=edge[1:])
    begin = np.concatenate([[0], ends[:-1]])
    stop = np.maximum(ends - span + 1, begin)
    edge[begin[begin < len(least)]] = True
    edge[stop[stop < len(least)]] = True
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(least)) - 1
    doc = np.searchsorted(ends, first, "right")
    inside = first < stop[doc]
    first, last, doc = first[inside], last[inside], doc[inside]
    if not len(first):
        return parse(data[:0], ends, span, k)
    place = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)
    trigger = _mix(kmer[place] + np.uint64(0xA0761D6478BD642F))
    phrase = _mix(roll.of(first, last + span) + (place - first).astype(np.uint64) * _R)
    return {"doc": doc, "first": first, "last": last, "at": place, "trigger": trigger, "phrase": phrase,
            "rolling": roll}


def _chunks(texts: pa.Array, limit: int = CHUNK):
    """(first document, byte buffer, document ends, base of each) of runs of texts.

    A text longer than the positions allow is parsed in pieces that overlap by
    SPAN - 1 bytes, so that every string lies whole in exactly one piece.
    """
    big = (1 << 24) - 1
    for i, j in tokenization.slices(texts, limit):
        raw = texts.slice(i, j - i).to_pylist()
        raw = [r if isinstance(r, bytes) else (r or "").encode("utf-8", "surrogatepass") for r in raw]
        if j - i == 1 and len(raw[0]) > big:
            for a in range(0, len(raw[0]) - SPAN + 1, big - SPAN + 1):
                piece = raw[0][a:a + big]
                yield i, np.frombuffer(piece, np.uint8), np.array([len(piece)]), np.array([a])
        else:
            ends = np.cumsum([len(r) for r in raw])
            yield i, np.frombuffer(b"".join(raw), np.uint8), ends, np.concatenate([[0], ends[:-1]]) * -1


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return cut, np.diff(np.append(cut, len(x)))


def _by_part(part: np.ndarray, parts: int) -> np.ndarray:
    """The order by part, equal ones as they come."""
    return np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of ``data``, cut into stretches of ``sizes``."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8).ravel())])


def _short(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _long(data: bytes, width: int) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :width] = short
    return out.view("<u8").ravel()


def _phrases(texts: pa.Array) -> dict[str, np.ndarray]:
    """doc, trigger and phrase hashes of the texts' phrases, in text order."""
    found = [(p["doc"] + i, p["trigger"], p["phrase"])
             for i, data, ends, _ in _chunks(texts) for p in [parse(data, ends)]]
    return {c: np.concatenate([f[n] for f in found]) for n, c in enumerate(("doc", "trigger", "phrase"))}


def _sender(parts: int):
    """Phrases by dictionary part: rows of (part, doc_ids, tags, counts, hashes)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("tags", pa.binary()),
                            ("counts", pa.binary()), ("triggers", pa.binary()), ("phrases", pa.binary())])
        for batch in batches:
            ids, tags = (np.asarray(batch.column(c), dtype=np.int64) for c in ("doc_id", "tag"))
            for i, j in tokenization.slices(batch.column("text"), PACKED):
                p = _phrases(batch.column("text").slice(i, j - i))
                part = (p["trigger"] % np.uint64(parts)).astype(np.int64)
                order = _by_part(part, parts)  # text order within a part
                part, doc = part[order], p["doc"][order]
                trigger, phrase = p["trigger"][order] // np.uint64(parts), p["phrase"][order]
                cut, size = _runs(part)
                rows = []
                for a, m in zip(cut.tolist(), size.tolist(), strict=True):
                    b = a + m
                    who, counts = _runs(doc[a:b])
                    who = doc[a:b][who] + i
                    # steps between doc_ids repeat, so the shuffle compresses them away
                    rows.append({"part": int(part[a]), "docs": np.diff(ids[who], prepend=0).astype("<i8").tobytes(),
                                 "tags": tags[who].astype("<u2").tobytes(), "counts": counts.astype("<u4").tobytes(),
                                 "triggers": _short(trigger[a:b], 5), "phrases": _short(phrase[a:b], 7)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return send


def _dictionary(key, rows, hot: int):
    """Whole duplicates (mark 1) and phrases to ask for (mark 2, of hot triggers 3), per document.

    ``marks`` has a byte for each phrase that the text has in this part, in text
    order; texts without a mark are left out.
    """
    part = key[0].as_py()
    cols = {c: rows.column(c).to_pylist() for c in ("docs", "tags", "counts", "triggers", "phrases")}
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in cols["counts"]]).astype(np.int64)
    ids = np.concatenate([np.cumsum(np.frombuffer(x, "<i8")) for x in cols["docs"]])
    tags = np.concatenate([np.frombuffer(x, "<u2") for x in cols["tags"]]).astype(np.int32)
    doc = np.repeat(ids, counts)
    trigger = np.concatenate([_long(x, 5) for x in cols["triggers"]])
    phrase = np.concatenate([_long(x, 7) for x in cols["phrases"]])
    order = np.lexsort((doc, phrase, trigger))
    t, f, d = trigger[order], phrase[order], doc[order]
    new_t = np.concatenate([[True], t[1:] != t[:-1]])
    new_f = new_t | np.concatenate([[True], f[1:] != f[:-1]])
    entry = np.cumsum(new_f) - 1
    smallest = d[new_f][entry]
    own = np.cumsum(new_t) - 1
    kinds = np.bincount(own[new_f])
    several = kinds[own] > 1
    mark = np.zeros(len(order), np.uint8)
    mark[order] = np.where(d > smallest, 1, np.where(kinds[own] > hot, 3, np.where(several, 2, 0))).astype(np.uint8)
    row = np.repeat(np.arange(len(counts)), counts)
    some = np.flatnonzero(np.bincount(row, mark, len(counts)))
    stop = np.cumsum(counts)
    return pa.table({
        "doc_id": pa.array(ids[some]), "tag": pa.array(tags[some], pa.int32()),
        "part": pa.array(np.full(len(some), part, np.int32)),
        "marks": pa.array([mark[stop[i] - counts[i]:stop[i]].tobytes() for i in some.tolist()], pa.binary())})


def _given(marks: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, marks): the marks of the texts' phrases by part * texts + text, joined."""
    flat = marks.flatten()
    text = np.repeat(np.arange(len(marks)), np.asarray(pc.list_value_length(marks)))
    key = np.asarray(pc.struct_field(flat, "part"), np.int64) * len(marks) + text
    raw = pc.struct_field(flat, "marks").to_pylist()
    order = np.argsort(key, kind="stable")
    key = key[order]
    if (key[1:] == key[:-1]).any():  # repeated rows have marks of their own: the greater counts
        most: dict[int, np.ndarray] = {}
        for k, i in zip(key.tolist(), order.tolist(), strict=True):
            got = np.frombuffer(raw[i], np.uint8)
            most[k] = np.maximum(most.get(k, got), got)
        return np.array(list(most), np.int64), np.concatenate(list(most.values()))
    return key, np.frombuffer(b"".join([raw[i] for i in order.tolist()]), np.uint8)


_ANSWER = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("spans", pa.binary()),
                     ("docs", pa.binary()), ("tags", pa.binary()), ("counts", pa.binary()), ("triggers", pa.binary()),
                     ("shapes", pa.binary()), ("bounds", pa.binary()), ("bytes", pa.binary())])


def _rows(n: int, **cols) -> pa.RecordBatch:
    none = {f.name: pa.nulls(n, f.type) for f in _ANSWER if f.name not in cols}
    made = {c: x if isinstance(x, pa.Array) else pa.array(x, _ANSWER.field(c).type) for c, x in cols.items()}
    return pa.RecordBatch.from_arrays([(none | made)[f.name] for f in _ANSWER], schema=_ANSWER)


def _answers(ids: np.ndarray, tags: np.ndarray, texts: pa.Array, marks: pa.Array, parts: int):
    """Batches for a run of texts: whole duplicates, asked phrases, strings of hot triggers."""
    found = [(i, data, base, parse(data, ends)) for i, data, ends, base in _chunks(texts)]
    doc, trigger = (np.concatenate(c) for c in zip(*[(p["doc"] + i, p["trigger"]) for i, _, _, p in found], strict=True))
    # places in the text, and in the chunks laid end to end
    lo, hi, away = (np.concatenate(c) for c in zip(*[
        (p["first"] + base[p["doc"]], p["last"] + base[p["doc"]], p["at"] - p["first"]) for _, _, base, p in found], strict=True))
    whole = np.concatenate([data for _, data, _, _ in found])
    before = np.cumsum([0] + [len(data) for _, data, _, _ in found])
    begin = np.concatenate([p["first"] + b for (_, _, _, p), b in zip(found, before.tolist())])
    part = (trigger % np.uint64(parts)).astype(np.int64)
    order = _by_part(part, parts)  # by part, text and place
    own = part[order] * len(texts) + doc[order]
    cut, size = _runs(own)
    keys, given = _given(marks, parts)
    mark = np.zeros(len(order), np.uint8)
    mark[order[np.repeat(np.isin(own[cut], keys), size)]] = given

    full = np.flatnonzero(mark == 1)
    if len(full):
        who, spans = _packed_spans(doc[full], lo[full], hi[full] + SPAN)
        yield _rows(len(who), doc_id=ids[who], tag=tags[who], spans=spans)
    asked = order[mark[order] == 2]
    if len(asked):
        cut, n = _runs(part[asked])
        new = np.ones(len(asked), bool)
        new[1:] = (doc[asked][1:] != doc[asked][:-1]) | (part[asked][1:] != part[asked][:-1])
        first = np.flatnonzero(new)
        who, counts = doc[asked][first], np.diff(np.append(first, len(asked)))
        n_docs = np.bincount(np.repeat(np.arange(len(cut)), n)[first], minlength=len(cut))
        length = hi[asked] - lo[asked] + SPAN
        stop = np.cumsum(length)
        width = np.int32 if int(stop[-1]) < 1 << 31 else np.int64
        at = np.repeat((begin[asked] - stop + length).astype(width), length)
        at += np.arange(int(stop[-1]), dtype=width)
        yield _rows(len(cut), part=part[asked][cut], docs=_binary(ids[who].astype("<i8"), n_docs * 8),
                    tags=_binary(tags[who].astype("<u2"), n_docs * 2), counts=_binary(counts.astype("<u4"), n_docs * 4),
                    triggers=_binary(trigger[asked].astype("<u8"), n * 8),
                    shapes=_binary(np.stack([away[asked], length], 1).astype(np.uint8), n * 2),
                    bounds=_binary(lo[asked].astype("<i8"), n * 8),
                    bytes=_binary(whole[at], np.add.reduceat(length, cut)))
    hot = np.flatnonzero(mark == 3)
    if len(hot):
        m = hi[hot] - lo[hot] + 1
        inner = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        which = np.repeat(hot, m)
        start = begin[which] + inner
        name = _mix(Rolling(whole).of(start, start + SPAN)
                    + _mix(trigger[which] + (away[which] - inner).astype(np.uint64) * _R))
        yield pa.RecordBatch.from_pylist(_dealt([(name, ids[doc[which]], tags[doc[which]], lo[which] + inner)], parts),
                                         schema=_ANSWER)


def _answer(parts: int):
    """Whole duplicates as intervals; the asked phrases as bytes for their part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, tags = (np.asarray(batch.column(c), dtype=np.int64) for c in ("doc_id", "tag"))
            squeezed, marks = batch.column("squeezed"), batch.column("marks")
            for i, j in _grown(squeezed, ANSWERED):
                texts = pa.array([grow(t) for t in squeezed.slice(i, j - i).to_pylist()], pa.large_binary())
                yield from _answers(ids[i:j], tags[i:j], texts, marks.slice(i, j - i), parts)
    return run


def _grown(squeezed: pa.Array, budget: int):
    """(start, stop) runs of compressed texts of about ``budget`` bytes."""
    start = size = 0
    for i, t in enumerate(squeezed):
        n = zstandard.frame_content_size(t.as_buffer())
        if i > start and size + n > budget:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(squeezed):
        yield start, len(squeezed)


def _packed_spans(own: np.ndarray, lo: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(owners, spans): each owner's maximal runs of intervals; touching ones join.

    Intervals come by owner; within one, starts and stops ascend.
    """
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (lo[1:] > stop[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own))[:len(first)] - 1
    pairs = np.stack([lo[first], stop[last]], 1).astype("<i8")
    cut, size = _runs(own[first])
    return own[first][cut], _binary(pairs, size * 16)


def _dealt(strings: list[tuple[np.ndarray, ...]], parts: int) -> list[dict]:
    """Rows of (name, doc_id, tag, place) strings, by name; parts below 0 hold such."""
    name, doc, tag, at = (np.concatenate(c) for c in zip(*strings, strict=True))
    part = (name % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cut, size = _runs(part[order])
    rows = []
    for c, n in zip(cut.tolist(), size.tolist(), strict=True):
        own = order[c:c + n]
        rows.append({"part": -1 - int(part[own[0]]), "doc_id": None, "tag": None, "spans": None,
                     "triggers": name[own].astype("<u8").tobytes(),
                     "bounds": np.stack([doc[own], tag[own], at[own]]).astype("<i8").tobytes(), "bytes": None})
    return rows


def _strings(key, rows):
    """The strings of hot triggers that a smaller doc_id has too, as intervals."""
    name = np.concatenate([np.frombuffer(x, "<u8") for x in rows.column("triggers").to_pylist()])
    doc, tag, at = np.concatenate([np.frombuffer(x, "<i8").reshape(3, -1) for x in rows.column("bounds").to_pylist()], 1)
    order = np.lexsort((doc, name))
    new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    late = order[doc[order] > doc[order][new][np.cumsum(new) - 1]]
    late = late[np.lexsort((at[late], tag[late], doc[late]))]
    doc, tag, at = doc[late], tag[late], at[late]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])) if len(doc) else late
    spans = [merged(np.stack([x, x + SPAN], 1)).astype("<i8").tobytes() for x in np.split(at, cut[1:])] if len(doc) else []
    return pa.table({"doc_id": pa.array(doc[cut], pa.int64()), "tag": pa.array(tag[cut], pa.int32()),
                     "spans": pa.array(spans, pa.binary())})


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, stop) intervals; touching ones join."""
    if not len(spans):
        return spans.reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], 1)


def _suffixes(key, rows):
    """Strings of one dictionary part that a smaller doc_id has too, as intervals."""
    def joined(column, kind):
        return np.frombuffer(b"".join(rows.column(column).to_pylist()), kind)
    ids, tags, counts = joined("docs", "<i8"), joined("tags", "<u2").astype(np.int32), joined("counts", "<u4")
    trigger, lo, data = joined("triggers", "<u8"), joined("bounds", "<i8"), joined("bytes", np.uint8)
    shapes = joined("shapes", np.uint8).reshape(-1, 2).astype(np.int64)
    own = np.repeat(np.arange(len(ids)), counts)
    # a phrase of m bytes has m - SPAN + 1 suffixes that are long enough
    m = shapes[:, 1] - SPAN + 1
    stop = np.cumsum(shapes[:, 1])
    begin = stop - shapes[:, 1]
    which = np.repeat(np.arange(len(m)), m)
    inner = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    digest = np.empty(len(which), np.uint64)
    a = done = 0
    while a < len(m):
        b = max(a + 1, int(np.searchsorted(stop, begin[a] + CHUNK, "right")))
        n = int(m[a:b].sum())
        start = begin[which[done:done + n]] + inner[done:done + n] - begin[a]
        digest[done:done + n] = Rolling(data[begin[a]:stop[b - 1]]).of(start, start + SPAN)
        a, done = b, done + n
    order = np.argsort(digest)
    same = digest[order][1:] == digest[order][:-1]
    # most strings are met once; the others are put in order with trigger and distance
    order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    t, a, h, d = trigger[which[order]], shapes[which[order], 0] - inner[order], digest[order], ids[own[which[order]]]
    by = np.lexsort((d, h, a, t))
    order, t, a, h, d = order[by], t[by], a[by], h[by], d[by]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (a[1:] != a[:-1]) | (h[1:] != h[:-1])
    late = order[d > d[new][np.cumsum(new) - 1]]
    at, by = lo[which[late]] + inner[late], own[which[late]]
    order = np.lexsort((at, by))
    who, spans = _packed_spans(by[order], at[order], at[order] + SPAN)
    return pa.table({"doc_id": pa.array(ids[who]), "tag": pa.array(tags[who], pa.int32()), "spans": spans})


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed UTF-8, so that joins shuffle half the bytes."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for i, j in tokenization.slices(batch.column("text"), PACKED):
            raw = (t.encode("utf-8", "surrogatepass") for t in batch.column("text").slice(i, j - i).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), batch.column("tag").slice(i, j - i),
                 pa.array([squeeze(r) for r in raw], pa.binary())], names=["doc_id", "tag", "squeezed"])


def duplicate_spans(docs: DataFrame, squeezed: DataFrame) -> DataFrame:
    """(doc_id, tag, spans): packed int64 pairs of the bytes of ``docs`` to remove.

    ``docs`` has doc_id, text and tag (the same for equal rows); ``squeezed`` has
    the texts compressed.
    """
    parts, hot = parts_for(text_bytes(docs), BYTES_PER_PART), HOT

    def dictionary(key, rows):
        return _dictionary(key, rows, hot)
    packed = docs.mapInArrow(_sender(parts), "part int, docs binary, tags binary, counts binary,"
                                             " triggers binary, phrases binary")
    marks = (packed.repartition(parts, "part").groupBy("part")
             .applyInArrow(dictionary, "doc_id long, tag int, part int, marks binary")
             .groupBy("doc_id", "tag").agg(F.collect_set(F.struct("part", "marks")).alias("marks")))
    answers = pinned(squeezed.join(marks, ["doc_id", "tag"]).mapInArrow(
        _answer(parts), "part int, doc_id long, tag int, spans binary, docs binary, tags binary, counts binary,"
                        " triggers binary, shapes binary, bounds binary, bytes binary"), "phrases")
    found = "doc_id long, tag int, spans binary"
    shared = answers.where("part >= 0").repartition(parts, "part").groupBy("part").applyInArrow(_suffixes, found)
    spread = answers.where("part < 0").repartition(parts, "part").groupBy("part").applyInArrow(_strings, found)
    return (answers.where("part IS NULL").select("doc_id", "tag", "spans").unionByName(shared).unionByName(spread)
            .groupBy("doc_id", "tag").agg(F.collect_set("spans").alias("spans")))


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, text, tag); a NULL doc_id counts as the smallest, a NULL text as empty.

    ``tag`` tells rows apart that repeat a doc_id with another text.
    """
    rows = id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID).cast("long")))
    return rows.withColumn("tag", F.pmod(F.xxhash64("text"), F.lit(1 << 16)).cast("int"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grow = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts, spans = batch.column("squeezed"), batch.column("spans").to_pylist()
        n_bytes, removed, runs, digest = [], [], [], []
        for t, packed in zip(texts, spans, strict=True):
            raw = grow(t.as_py())
            found = [np.frombuffer(s, "<i8").reshape(-1, 2) for s in packed or ()]
            gone = merged(np.concatenate(found)) if found else np.zeros((0, 2), np.int64)
            h, at = hashlib.sha256(), 0
            for a, b in gone.tolist():
                h.update(raw[at:a])
                at = b
            h.update(raw[at:])
            n_bytes.append(len(raw))
            removed.append(int((gone[:, 1] - gone[:, 0]).sum()))
            runs.append(len(gone))
            digest.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row a row of ``docs``.

    Rows that repeat a doc_id do not count as smaller than each other; extra columns
    are dropped; an empty table gives no row.
    """
    rows = tagged(docs)
    squeezed = rows.mapInArrow(_squeeze, "doc_id long, tag int, squeezed binary")
    spans = duplicate_spans(rows, squeezed)
    cut = squeezed.join(spans, ["doc_id", "tag"], "left").select("doc_id", "squeezed", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def op10_prefix_free_dedup(spark, sf_dir: str) -> DataFrame:
    from flightdeck.llm.common import documents
    return deduplicated(documents(spark, sf_dir))
