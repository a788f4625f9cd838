"""Whole-text token ids through the tokenizers library, a batch at a time.

Text is cut where no pre-token can cross, and each distinct piece of a batch is
encoded once, so a batch costs one hash-encode over its pieces plus the library's
work on pieces a worker has not met yet.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces a worker remembers before it starts anew.
CACHE_PIECES = 600_000

# any white space but a single blank or line feed between other characters, and
# the separators on whose class regex engines differ
_UNUSUAL = ("[ \\n]{2}|^[ \\n]|[ \\n]$|[\\x{1}\\x{2}\\t\\v\\f\\r\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}"
            "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
# U+0130 is left out: it lower-cases to two characters
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_WORD = rf"^ ?[{_LETTERS}]+$"
# a comma or full stop before a blank, after anything but a letter
_JOINED_MARK = rf"(?:^|[^{_LETTERS}])[.,][ \n]"
_SIMPLE = re.compile(rf"([ \n]?)([{_LETTERS}]*)([.,!?;:|$&*%#]*)")


def _byte_chars() -> dict[int, str]:
    """Byte -> printable character, as byte-level vocabularies spell bytes."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class PieceEncoder:
    """ids of whole texts for one vocabulary file.

    ``kind`` "byte": a byte-level BPE with a blank before words.  ``kind`` "word":
    lower-cased BPE that drops white space.  A text with unusual white space, or with
    the literal of an added token, is handed to the library as it is; the others are cut at single blanks and line
    feeds, which the pre-tokenizers of both kinds never cross.
    """

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.kind = kind
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # texts are searched before they are cut and without regard to case, which
        # finds at least what the library finds before or after its normalizer
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = "(?i)" + "|".join(added) if added else None
        self.table = _byte_chars()
        self.known: dict[str, int] = {}
        self._reset()

    def _reset(self):
        self.known.clear()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int32)

    def forget(self):
        """Give up all pieces, so that a worker that waits holds no more than the vocabulary."""
        self._reset()

    def _forget_rare(self):
        """Keep the pieces that more than one batch had; most others are met once."""
        n = len(self.known)
        keep = np.flatnonzero(self.met[:n] > 1)
        pieces, starts, lens, flat = list(self.known), self.starts[keep], self.lens[keep], self.flat
        self._reset()
        if len(keep) < CACHE_PIECES // 2:
            self._store([pieces[i] for i in keep.tolist()], lens,
                        flat[np.repeat(starts - np.cumsum(lens) + lens, lens) + np.arange(int(lens.sum()))])

    def _room(self, total: int):
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])

    def _store(self, pieces: list[str], lens: np.ndarray, ids: np.ndarray):
        """Remember pieces, each given once: a piece's slot is its place in ``known``."""
        first, total = len(self.known), len(ids)
        self._room(total)
        while first + len(pieces) > len(self.starts):
            self.starts, self.lens, self.met = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens, self.met))
        self.flat[self.used:self.used + total] = ids
        self.starts[first:first + len(pieces)] = self.used + np.cumsum(lens) - lens
        self.lens[first:first + len(pieces)] = lens
        self.used += total
        self.known.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lens, ids) of pieces: words in one go, the rest one by one."""
        is_word = np.asarray(pc.match_substring_regex(pa.array(pieces, pa.large_string()), _WORD)).tolist()
        words = [p for p, w in zip(pieces, is_word, strict=True) if w]
        joined = "\n".join(words)
        joined = joined.lower() if self.kind == "word" else joined
        spelt = joined.encode().decode("latin-1").translate(self.table).split(self.table[10])
        if self.kind == "word":
            spelt = [w.lstrip(self.table[32]) for w in spelt]
        tokenize = self.model.tokenize
        next_word = iter(spelt).__next__
        # one flat list: a list for each piece would keep the garbage collector busy
        lens, ids = [], []
        for p, w in zip(pieces, is_word, strict=True):
            got = [t.id for t in tokenize(next_word())] if w else self._piece_ids(p)
            lens.append(len(got))
            ids += got
        return np.array(lens, np.int64), np.array(ids, np.uint32)

    def _piece_ids(self, piece: str) -> list[int]:
        m = _SIMPLE.fullmatch(piece)
        if m is None or not piece:
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        lead, word, marks = m.groups()
        if self.kind == "word":
            parts = [word.lower(), marks]
        elif lead == "\n":
            parts = [lead, word, marks]
        else:
            parts = [lead + word, marks] if word else [lead + marks]
        spelt = (p.encode().decode("latin-1").translate(self.table) for p in parts if p)
        return [t.id for s in spelt for t in self.model.tokenize(s)]

    def _slots(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_PIECES:
            self._forget_rare()
        slots = np.fromiter(map(self.known.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            once = list(dict.fromkeys(new))  # marks that were cut off may leave a piece twice
            self._store(once, *self._ids_of(once))
            slots[missing] = [self.known[p] for p in new]
        self.met[slots] += 1
        return slots

    def encode(self, texts: pa.Array, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ids of every text followed by ``end_id``, concatenated.

        NULL and empty texts give the end id alone.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.asarray(pc.match_substring_regex(texts, _UNUSUAL))
        if self.added:
            odd = odd | np.asarray(pc.match_substring_regex(texts, self.added))
        plain = pc.if_else(pa.array(odd), "", texts)
        marked = pc.replace_substring(plain, "\n", " \n")
        # after a letter, a comma or full stop is a pre-token of its own: \x02 tells
        # that no blank stood before it
        apart = marked
        for m in ".,":
            apart = pc.replace_substring(apart, m + " ", f" \x02{m} ")
        marked = pc.if_else(pc.match_substring_regex(plain, _JOINED_MARK), marked, apart)
        if self.kind == "byte":
            # every piece but a text's first carries its blank; the first is marked
            mark, none = (pa.scalar(s, pa.large_string()) for s in ("\x01", ""))
            marked = pc.binary_join_element_wise(mark, marked, none)
        cut = pc.split_pattern(marked, " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.kind == "byte":
            words = [w[1:] if w[:1] in ("\x01", "\x02") else w if w[:1] == "\n" else " " + w for w in words]
        else:
            words = [w[1:] if w[:1] == "\x02" else w for w in words]
        slot = self._slots(words)[np.asarray(coded.indices)] if words else np.zeros(0, np.int64)
        whole = [np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
                 for i in np.flatnonzero(odd)]
        # behind the known ids, for this call alone: the end id and the ids of whole texts
        extra = np.concatenate([np.array([end_id], np.uint32), *whole])
        self._room(len(extra))
        self.flat[self.used:self.used + len(extra)] = extra
        # per text its pieces, then a place for the text handed over whole, then the end id
        whole_at = np.asarray(cut.offsets)[1:].astype(np.int64) + 2 * np.arange(len(texts))
        length = np.ones(len(slot) + 2 * len(texts), np.int64)
        begin = np.full(len(length), self.used, np.int64)
        own = np.ones(len(length), bool)
        own[whole_at] = own[whole_at + 1] = False
        length[own], begin[own] = self.lens[slot], self.starts[slot]
        size = np.zeros(len(texts), np.int64)
        size[odd] = [len(a) for a in whole]
        length[whole_at] = size
        begin[whole_at] += 1 + np.cumsum(size) - size
        after = np.cumsum(length)
        total = int(after[-1]) if len(after) else 0
        width = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        at = np.repeat((begin - after + length).astype(width), length)
        at += np.arange(total, dtype=width)
        return self.flat[at], after[whole_at + 1]


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, kind: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file, kept between batches."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = PieceEncoder(path, kind)
    return _ENCODERS[path, kind]


def slices(texts: pa.Array, budget: int = 8 << 20):
    """(start, stop) runs of a text array of at most about ``budget`` bytes each."""
    n = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start, size = 0, 0
    for i, b in enumerate(n.tolist()):
        if i > start and size + b > budget:
            yield start, i
            start, size = i, 0
        size += b
    if start < len(n):
        yield start, len(n)
