"""Bytes of an Arrow text column, taken in slabs of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes taken at a time, so that working arrays stay in the processor's caches.
SLAB = 1 << 19


class Slab(NamedTuple):
    """Bytes ``start`` to ``end`` of rows ``first`` to ``last``; a long row comes alone, in several slabs."""

    first: int
    last: int
    start: int
    end: int
    continued: bool


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without a copy: row i is ``bytes[offsets[i]:offsets[i + 1]]``. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8), offsets


def slabs(data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray) -> Iterator[Slab]:
    """All rows in order, neighbours together up to ``SLAB`` bytes. A longer row is cut after bytes that ``is_gap``
    (a table of 256) marks, so no word is cut; a slab is longer than ``SLAB`` only if a word is."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        last = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLAB, side="right")) - 1)
        start, stop = int(offsets[at]), int(offsets[last])
        cuts = False
        while stop - start > SLAB:
            cut, end = start + SLAB, 0
            while not end and cut < stop:
                gaps = np.flatnonzero(is_gap[data[cut : cut + SLAB]])
                end, cut = (cut + int(gaps[0]) + 1, cut) if len(gaps) else (0, cut + SLAB)
            if not end or end >= stop:
                break
            yield Slab(at, last, start, end, cuts)
            start, cuts = end, True
        yield Slab(at, last, start, stop, cuts)
        at = last


#: A-Z in lower case, byte by byte; and the bytes that stand between words of ASCII letters and digits and of any other
#: characters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_GAP = np.ones(256, bool)
IS_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_spans(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word of a slab's bytes, and its row, counted from the first; ``bounds`` are those of rows."""
    inside = np.zeros(len(part) + 2, bool)
    inside[1:-1] = ~IS_GAP[part]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # A row's end ends a word even if the next row begins with one.
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(part))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    begins[cuts] = ends[cuts] = True
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends), np.searchsorted(bounds, start, side="right") - 1
