"""Hashes of tokens and of their prefixes, vectorised over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes taken at a time; a longer text is cut at white space.
SLAB = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_SPACE, _WORD, _SIGN = 0, 1, 2
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = _WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLAB + 1024)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit into the low ones."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Tokens:
    """Tokens of a piece of text: runs of letters, digits and non-ASCII bytes, or of other signs; A-Z in lower case."""

    def __init__(self, raw: bytes):
        data = _LOWER[np.frombuffer(raw, np.uint8)]
        kind = _KIND[data]
        edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(255), append=np.uint8(255)))
        first, last = edge[:-1], edge[1:]
        real = kind[first] != _SPACE
        self.start, self.end = first[real], last[real]
        self.is_word = kind[self.start] == _WORD
        up, self._down = powers(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self._sum[1:])

    def hashes(self, length: int | None = None) -> np.ndarray:
        """A hash of each token, or of its first ``length`` bytes; the same wherever the token stands."""
        end = self.end if length is None else np.minimum(self.start + length, self.end)
        return mixed((self._sum[end] - self._sum[self.start]) * self._down[self.start])


def pieces(text: str | bytes) -> Iterator[bytes]:
    """A text as UTF-8, cut after white space into pieces of about ``SLAB`` bytes, or longer if a token is."""
    raw = text.encode() if isinstance(text, str) else text
    start = 0
    while len(raw) - start > SLAB:
        cut = start + SLAB
        while cut < len(raw) and _KIND[raw[cut]] != _SPACE:
            cut += 1
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def batches(texts: Sequence[str]) -> Iterator[tuple[int, int, Tokens, np.ndarray]]:
    """Neighbouring texts taken together: ``(first, n, tokens, row)``, where ``row`` is each token's text from 0 to n - 1.

    A text longer than a slab comes alone, in several batches with the same ``first``.
    """
    at = 0
    while at < len(texts):
        taken, size = [], 0
        while at + len(taken) < len(texts):
            raw = texts[at + len(taken)].encode()
            if taken and size + len(raw) > SLAB:
                break
            taken.append(raw)
            size += len(raw) + 1
        if len(taken) == 1:
            for piece in pieces(taken[0]):
                tokens = Tokens(piece)
                yield at, 1, tokens, np.zeros(len(tokens.start), np.int64)
        else:
            bounds = np.cumsum([len(t) + 1 for t in taken])
            tokens = Tokens(b"\n".join(taken))
            yield at, len(taken), tokens, np.searchsorted(bounds, tokens.start, side="right")
        at += len(taken)
