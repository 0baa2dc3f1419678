"""Words of UTF-8 texts as numpy arrays: runs of digits, ASCII letters (lower-cased) and non-ASCII characters."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0") : ord("9") + 1] = IS_WORD[ord("a") : ord("z") + 1] = IS_WORD[128:] = True
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
SEGMENT = 1 << 20


class Words(NamedTuple):
    """Of one text: byte offsets of each word's start and end, and a 64-bit hash of its letters."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _scan(data: bytes) -> Words:
    folded = FOLD[np.frombuffer(b"\0" + data + b"\0", np.uint8)]
    inside = IS_WORD[folded]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]  # in data
    size = end - start
    if not len(size):
        return Words(start, end, np.zeros(0, np.uint64))
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(size.sum()) - np.repeat(at, size)
    turn = (place >> 8).astype(np.uint64)
    parts = _BYTE[folded[1:-1][inside[1:-1]]] * (_PLACE[place & 255] + (turn << np.uint64(1)))
    return Words(start, end, mix(np.add.reduceat(parts, at) + size.astype(np.uint64)))


def segments(data: bytes, size: int = SEGMENT) -> Iterator[tuple[int, bytes]]:
    """(offset, piece): pieces of about size bytes that together are data and split no word."""
    at = 0
    while at < len(data):
        to = min(len(data), at + size)
        while to < len(data) and IS_WORD[FOLD[data[to]]]:
            to += 1
        yield at, data[at:to]
        at = to


def scan(data: bytes) -> Words:
    """The words of one text; temporary memory does not grow with it."""
    if len(data) <= SEGMENT:
        return _scan(data)
    found = [(at, _scan(part)) for at, part in segments(data)]
    return Words(np.concatenate([w.start + at for at, w in found]), np.concatenate([w.end + at for at, w in found]), np.concatenate([w.hash for _, w in found]))


def scan_all(texts: list[bytes]) -> Iterator[Words]:
    """scan of each text; short ones are scanned together."""
    some: list[bytes] = []
    held = 0
    for text in texts:
        if held and held + len(text) > SEGMENT:
            yield from _together(some)
            some, held = [], 0
        some.append(text)
        held += len(text) + 1
    yield from _together(some)


def _together(some: list[bytes]) -> Iterator[Words]:
    if len(some) < 2:
        yield from map(scan, some)
        return
    all_ = _scan(b"\0".join(some))
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in some])))
    cut = np.searchsorted(all_.start, at)
    for i in range(len(some)):
        a, b = cut[i], cut[i + 1]
        yield Words(all_.start[a:b] - at[i], all_.end[a:b] - at[i], all_.hash[a:b])


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes; null is empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
