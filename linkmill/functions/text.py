"""Word tokens, n-grams and MinHash signatures, row by row: no explode, no shuffle.

Tokens and their hashes are Spark expressions; what is computed from the hashes goes over arrays of many texts at once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens are runs of letters, digits and underscore, or one other visible character.
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"

# Near-duplicate settings.
NGRAM = 5
NUM_PERM = 10
THRESHOLD = 0.5

# The hash family (universal hashing modulo a Mersenne prime).
PRIME = 2**31 - 1
HASH_A_STEP = 1000003
HASH_A_BASE = 7919
HASH_B_STEP = 104729
HASH_BASE = 48271

#: Tokens whose runs are hashed at a time, so that the arrays stay in a core's cache.
SLAB = 1 << 16


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def ngrams(toks: Column, n: int = NGRAM) -> Column:
    """All n-grams in order, tokens joined by one space; empty for fewer than ``n`` tokens."""
    firsts = F.slice(toks, 1, F.greatest(F.size(toks) - (n - 1), F.lit(0)))

    def gram(first: Column, i: Column) -> Column:
        rest = [piece for k in range(1, n) for piece in (F.lit(" "), F.get(toks, i + k))]
        return F.concat(first, *rest)

    return F.transform(firsts, gram)


def token_hashes(text: Column) -> Column:
    """A number below the prime for each token: its CRC-32 modulo the prime."""
    return F.transform(tokens(text), lambda t: F.crc32(t) % PRIME)


def _modulo_prime(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, for unsigned numbers below the prime's square: it is one less than a power of 2."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.minimum(x, x - np.uint64(PRIME))  # below the prime the difference wraps around and is huge


def gram_hashes(one: np.ndarray) -> np.ndarray:
    """For every run of ``NGRAM`` token hashes the number with these digits in base ``HASH_BASE``, modulo the prime; runs
    are put together by doubling."""

    def joined(left: np.ndarray, right: np.ndarray, shift: int, width: int) -> np.ndarray:
        size = max(min(len(left), len(right) - shift), 0)
        return _modulo_prime(left[:size] * np.uint64(pow(HASH_BASE, width, PRIME)) + right[shift : shift + size])

    two = joined(one, one, 1, 1)
    return joined(joined(two, two, 2, 2), one, 4, 1)


def permutation(k: int) -> tuple[int, int]:
    """Multiplier and offset of permutation ``k``."""
    return (HASH_A_STEP * (k + 1) + HASH_A_BASE) % PRIME, HASH_B_STEP * k


def minima(hashes: np.ndarray, offsets: np.ndarray, num_perm: int) -> np.ndarray:
    """For each text the minimum of each permutation over the hashes of its n-grams, the prime itself if it has none.
    ``offsets`` say where the token hashes of each text begin, and where the last ones end."""
    found = np.full((len(offsets) - 1, num_perm), PRIME, np.uint64)
    rows = np.flatnonzero(np.diff(offsets))
    starts = offsets[rows]
    # A run must not begin at the last tokens of a text.
    cut = np.zeros(len(hashes) + NGRAM, bool)
    for k in range(1, NGRAM):
        cut[offsets[1:] - k] = True
    hashes = np.concatenate([hashes, np.zeros(NGRAM - 1, hashes.dtype)]).astype(np.uint64)
    for at in range(int(offsets[0]), int(offsets[-1]), SLAB):
        end = min(at + SLAB, int(offsets[-1]))
        grams, outside = gram_hashes(hashes[at : end + NGRAM - 1]), cut[at:end]
        low, high = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, end)
        own, places = rows[low:high], np.maximum(starts[low:high] - at, 0)
        for k in range(num_perm):
            a, b = permutation(k)
            slots = _modulo_prime(grams * np.uint64(a) + np.uint64(b))
            slots[outside] = PRIME
            found[own, k] = np.minimum(found[own, k], np.minimum.reduceat(slots, places))
    return found


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once per row.

    A lambda variable, not a column of an earlier projection: the optimizer may inline such a column wherever it
    is used, even into the body of another lambda, where it would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_list(text: Column, n: int = NGRAM) -> Column:
    return bound(tokens(text), lambda t: ngrams(t, n))


def signature(text: Column, num_perm: int = NUM_PERM) -> Column:
    """MinHash signature of the whole text. The minimum over a set equals the minimum over the list it came
    from, so duplicates among the n-grams are not removed first."""

    def signed(hashes: pa.Array) -> pa.Array:
        found = minima(hashes.values.to_numpy(zero_copy_only=False), hashes.offsets.to_numpy(), num_perm)
        ends = pa.array(np.arange(len(found) + 1) * num_perm, pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(found.ravel().astype(np.int64)))

    # Null has no tokens.
    hashes = F.coalesce(token_hashes(text), F.array().cast("array<bigint>"))
    return F.arrow_udf(signed, "array<bigint>")(hashes)


def with_shingles(df: DataFrame, text: str = "text", n: int = NGRAM) -> DataFrame:
    """Adds ``shingles``: the distinct word n-grams of the whole text."""
    return df.withColumn("shingles", F.array_distinct(shingle_list(F.col(text), n)))


def with_signature(df: DataFrame, text: str = "text", num_perm: int = NUM_PERM, tasks: int | None = None) -> DataFrame:
    """Adds ``sig``, the MinHash signature.

    Hashing costs far more than moving the text. Input that comes in fewer splits than there are cores, such as a
    Parquet file of one row group, can be dealt out first: ``tasks`` is the number of partitions then made.
    """
    dealt = df if tasks is None else df.repartition(tasks)
    return dealt.withColumn("sig", signature(F.col(text), num_perm))


@lru_cache(maxsize=64)
def band_shape(
    threshold: float = THRESHOLD, num_perm: int = NUM_PERM, fp_weight: float = 0.5, fn_weight: float = 0.5
) -> tuple[int, int]:
    """(bands, rows) with the least weighted false-positive and false-negative area at ``threshold``."""

    def area(low: float, high: float, f) -> float:
        steps = 2000
        width = (high - low) / steps
        return sum(f(low + (i + 0.5) * width) for i in range(steps)) * width

    def cost(shape: tuple[int, int]) -> float:
        bands, rows = shape
        hit = lambda s: 1.0 - (1.0 - s**rows) ** bands
        return fp_weight * area(0.0, threshold, hit) + fn_weight * area(threshold, 1.0, lambda s: 1.0 - hit(s))

    shapes = [(b, r) for b in range(1, num_perm + 1) for r in range(1, num_perm // b + 1)]
    return min(shapes, key=cost)


def band_keys(sig: Column, bands: int, rows: int) -> Column:
    """One text key per band: its signature slots joined by ``-``."""

    def keys(s: Column) -> Column:
        slots = [[F.get(s, F.lit(b * rows + r)).cast("string") for r in range(rows)] for b in range(bands)]
        return F.array(*[F.concat_ws("-", *band) for band in slots])

    return bound(sig, keys)


def with_bands(
    df: DataFrame, threshold: float = THRESHOLD, num_perm: int = NUM_PERM, sig: str = "sig"
) -> DataFrame:
    """Adds ``bands``, the LSH band keys of a signature."""
    bands, rows = band_shape(threshold, num_perm)
    return df.withColumn("bands", band_keys(F.col(sig), bands, rows))
