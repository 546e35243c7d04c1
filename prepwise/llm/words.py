"""Vectorised words of text batches: positions, documents and 64-bit hashes."""
from __future__ import annotations

import numpy as np
import pandas as pd

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_WORD = bytes(0 if b == 32 or 9 <= b <= 13 else 1 for b in range(256))
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)          # the first n bytes of a lane
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h = h ^ (h >> np.uint64(29))
    h = h * _ODD
    return h ^ (h >> np.uint64(32))


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: the hash of every word of the texts in order, and words per text.

    Words are runs of other bytes than space and U+0009..U+000D, A-Z lower-cased."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b" ".join([b"", *raw, b" " * 16]).translate(_LOWER)
    edge = np.flatnonzero(np.diff(np.frombuffer(data.translate(_IS_WORD), np.int8)))     # word starts and ends in turn
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    lens = ends - starts
    lanes = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    # the first eight bytes of every word, then the rest of the longer ones
    h = lens.astype(np.uint64) * _ODD
    h = mix(h ^ (lanes[starts] & _MASKS[np.minimum(lens, 8)]))
    live, at = np.flatnonzero(lens > 8), 8
    while len(live):
        left = lens[live] - at
        h[live] = mix(h[live] ^ (lanes[starts[live] + at] & _MASKS[np.minimum(left, 8)]))
        live, at = live[left > 8], at + 8
    begin = np.cumsum([1, *[len(r) + 1 for r in raw]])
    return h, np.diff(np.searchsorted(starts, begin))


def distinct_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sorted distinct values, place of each value among them)``."""
    codes, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[codes]


def batches_of(texts, limit: int):
    """Ranges ``(from, to)`` of rows whose texts together reach ``limit`` characters."""
    return runs_of([len(t or "") for t in texts], limit)


def runs_of(lengths, limit: int):
    """Ranges ``(from, to)`` of rows whose ``lengths`` together reach ``limit``."""
    begin, held = 0, 0
    for i, n in enumerate(lengths):
        held += n
        if held >= limit:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(lengths):
        yield begin, len(lengths)
