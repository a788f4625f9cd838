"""Hashed character features of batches of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from flightdeck.llm import tokenization

#: Cells of a count matrix that are worked on at once.
BLOCK_CELLS = 1 << 21
_MIX = np.uint32(0x9E3779B1)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key's text, modulo ``parts``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def _letters() -> np.ndarray:
    """For every code point up to U+FFFF: is it a letter (0 beyond: no)."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


_IS_LETTER: list[np.ndarray] = []


def is_letter(codes: np.ndarray) -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    low = np.minimum(codes, 0xFFFF)
    high = codes > 0xFFFF
    out = _IS_LETTER[0][low] & ~high
    if high.any():
        out[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ends) of the texts, each followed by one blank."""
    joined = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return joined, np.cumsum([len(t) + 1 for t in texts])


def gram_hash(codes: np.ndarray, n: int, salt: int, bits: int) -> np.ndarray:
    """A bucket for each window of ``n`` codes that starts at a position."""
    h = np.full(max(len(codes) - n + 1, 0), salt, np.uint32)
    for j in range(n):
        h = (h ^ codes[j:j + len(h)].astype(np.uint32)) * _MIX
        h ^= h >> np.uint32(15)
    return (h * _MIX) >> np.uint32(32 - bits)


def blocks(texts: pa.Array, cells: int):
    """(start, stop) runs of texts small enough for a count matrix of ``cells`` columns."""
    step = max(1, BLOCK_CELLS // cells)
    for i, j in tokenization.slices(texts, 4 << 20):
        for k in range(i, j, step):
            yield k, min(j, k + step)
