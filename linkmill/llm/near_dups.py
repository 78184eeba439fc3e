"""SimHash near-duplicates through deletion variants.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in at most 3 bits, one
segment differs in at most one. So each segment is indexed as it is and with each of its bits as a wildcard, and an
equality join on these variants meets every link; the whole distance is then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import table
from linkmill.llm.components import components
from linkmill.session import scratch_path, written, written_with

#: Words of a shingle, seed of its hash, and the most bits in which linked fingerprints differ.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Shingles hashed at a time, so that a very long text needs no more memory than a long one.
SLAB = 1 << 16
#: Fingerprints in one variant's bucket beyond which the bucket is indexed again by its other bits. No link depends
#: on it; it only bounds how many comparisons a bucket takes.
FULL_BUCKET = 512


def simhash(text: str) -> int:
    """Bit b is set if more than half of the shingles' XXH64 have it set; 0 for a text without words."""
    import xxhash

    digest = xxhash.xxh64_digest
    words = text.encode().lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(len(words) - SHINGLE + 1, 1)
    tally = np.zeros(64, np.int64)
    for at in range(0, n, SLAB):
        until = min(at + SLAB, n)
        if len(words) < SHINGLE:
            hashes = [digest(joined, SEED)]
        else:
            lasts = ends[at + SHINGLE - 1 : until + SHINGLE - 1]
            hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at:until], lasts, strict=True)]
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8)).reshape(-1, 64)
        tally += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(tally * 2 > n).tobytes(), "big", signed=True)


def _simhashes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([simhash(t) for t in part], dtype="int64")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a 64-bit number in two's complement; null counts as empty."""
    return F.pandas_udf(_simhashes, T.LongType())(F.coalesce(text, F.lit("")))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _variants(shift: int, width: int, left: bool, first: bool) -> Column:
    """Hashed keys of one segment: itself, and itself with one bit as a wildcard.

    A wildcard key carries the bit it hides on the left side and its opposite on the right one: only fingerprints
    that differ there meet, and equal segments meet once, in the segment's own key. On the first level both sides
    are the same fingerprints, so the left one takes the hidden 0 and the right one the hidden 1.
    """
    own, seg = F.lit(shift), _part(F.col("fp"), shift, width)
    keys = [F.xxhash64(F.col("bucket"), own, F.lit(-1), seg)]
    for p in range(width):
        hidden = F.shiftrightunsigned(seg, p).bitwiseAND(F.lit(1))
        wild = seg.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << p)))
        if first:
            keys.append(F.when(hidden == (0 if left else 1), F.xxhash64(F.col("bucket"), own, F.lit(p), wild)))
        else:
            keys.append(F.xxhash64(F.col("bucket"), own, F.lit(p), wild, hidden if left else 1 - hidden))
    return F.array(*keys)


def _indexed(rows: DataFrame, width: int, left: bool, first: bool) -> DataFrame:
    """``(fp, key, rest)``: one row for each variant; ``rest`` is where the bits that the key doesn't fix begin."""
    found = None
    shifts = [(32, 0), (0, 32)] if first else [(b + o, b + width - o) for b in range(0, 64, 2 * width) for o in (0, width)]
    for shift, rest in shifts:
        mine = rows if first else rows.where(F.col("rest") == shift // (2 * width) * 2 * width)
        keys = mine.select("fp", F.explode(_variants(shift, width, left, first)).alias("key"), F.lit(rest).alias("rest"))
        found = keys if found is None else found.unionByName(keys)
    return found.where("key is not null")


def _close(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs that share a key and are close. Spark sizes exploded variants like the fingerprints they come from, some
    30 times too low, and would broadcast them; so the join is told to shuffle."""
    r = right.select(F.col("fp").alias("other"), F.col("key").alias("key"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE
    return left.join(r.hint("merge"), (left["key"] == r["key"]) & near & (F.col("fp") != F.col("other"))).select("fp", "other")


def links(fingerprints: DataFrame, full_bucket: int = FULL_BUCKET) -> DataFrame:
    """``(a, b)`` with a < b: every pair of distinct fingerprints (column ``fp``) that differ in at most 3 bits.

    A bucket with many fingerprints, such as a swarm of near copies makes, is indexed again by the segments of the
    bits its variant doesn't fix: of 32 such bits in segments of 16, then of 16 in segments of 8. Each time one
    segment of two linked fingerprints differs in at most one bit, so no link is lost, and in the end a bucket holds
    fingerprints that can differ in 8 bits only.
    """
    spark = fingerprints.sparkSession
    rows = fingerprints.select("fp").where("fp is not null").distinct().withColumn("bucket", F.lit(0).cast("long"))
    sides, found = (rows, rows), []
    for width in (32, 16, 8):
        first = width == 32
        left, right = (_indexed(side, width, is_left, first) for side, is_left in zip(sides, (True, False), strict=True))
        if width == 8:
            found.append(_close(left, right))
            break
        both = left.unionByName(right)
        many = both.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > full_bucket).select("key")
        full, some = written_with(many, scratch_path(spark, "full-buckets"), F.count(F.lit(1)))
        if not some:
            found.append(_close(left, right))
            break
        found.append(_close(left.join(full, "key", "left_anti"), right.join(full, "key", "left_anti")))
        sides = tuple(
            written(side.join(full, "key", "left_semi").select("fp", F.col("key").alias("bucket"), "rest").distinct(), "bucket-rows")
            for side in (left, right)
        )
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", full_bucket: int = FULL_BUCKET, place: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, a row for each row of ``docs``.

    ``fingerprint`` is 16 hex digits over the whole text; ``component_id`` is the smallest id reachable over links,
    the row's own included. Null and empty texts have fingerprint zero and are linked like any other. Null ids are
    never a smallest id unless a component has no other. Repeated rows are returned as often as they come. Other
    columns of ``docs`` are not read; an empty table gives no rows. With the columns of each row's ``place``, these
    are returned too, and ``kept``: true for one row of each component, that of the smallest (id, place), null ids last.

    Texts are read once and only ids and fingerprints are shuffled. Equal fingerprints, whatever their number, are
    one row for the links, reduced map-side; the join back has its exchange on both sides, so that a fingerprint
    with a third of all rows can be split.
    """
    at = [F.col(f"`{c}`") for c in place]
    marked = written(docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("fp"), *at), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), "id", *at) if place else F.col("id")
    distinct = written(marked.groupBy("fp").agg(F.min(order).alias("least")), "simhash-distinct")
    found = written(links(distinct, full_bucket), "simhash-links")
    parts = written(components(found, "a", "b").select(F.col("node").alias("fp"), "component"), "simhash-parts")
    # Places name files, which are stored once and so count next to nothing in a table's size, but come whole with each
    # row of a broadcast. Tables with a row for each fingerprint are therefore never broadcast.
    lowest = parts.join(distinct.hint("merge"), "fp").groupBy("component").agg(F.min("least").alias("lowest"))
    linked = parts.join(lowest, "component").select("fp", "lowest")
    labels = written(
        distinct.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "least").alias("first")), "simhash-labels"
    )
    first = F.col("first.id" if place else "first").alias("component_id")
    is_first = [F.struct(*at) == F.struct(*[F.col("first")[c].alias(c) for c in place])] if place else []
    return marked.join(labels.hint("merge"), "fp").select(
        F.col("id").alias(doc_id), as_hex(F.col("fp")).alias("fingerprint"), first, *at, *[k.alias("kept") for k in is_first]
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
