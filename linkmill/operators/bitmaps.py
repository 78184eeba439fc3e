"""Removal of documents by address without moving them: dropped ordinals as bit maps that meet the scan.

A bit map covers 32,768 ordinals of one file in 4 KB. A bounded number of them is broadcast at a time, so documents are
read, tested and written in one narrow pass, however many are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.operators.ordinals import with_ordinal
from linkmill.session import written

#: Bit maps broadcast at once: 64 MB.
MAPS_AT_ONCE = 1 << 14


def _page(ordinal: Column) -> Column:
    """Spark's buckets of 32,768 bits begin with number 1."""
    return F.bitmap_bucket_number(ordinal + 1)


def ordinal_bitmaps(dropped: DataFrame, file: str = "source_file", ordinal: str = "doc_ord") -> DataFrame:
    """(file, page, bits) for a list of addresses; repeated addresses count once, maps combine map-side."""
    at = F.col(ordinal) + 1
    return dropped.groupBy(F.col(file).alias("file"), _page(F.col(ordinal)).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def without_addresses(docs: DataFrame, maps: DataFrame, file: str = "source_file", ordinal: str = "doc_ord") -> DataFrame:
    """``docs`` without those whose bit is set, for at most ``MAPS_AT_ONCE`` maps. A row without an address stays."""
    place = F.bitmap_bit_position(F.col(ordinal) + 1)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, cast(_place % 8 as int))").bitwiseAND(F.lit(1)) == 1
    some = F.broadcast(maps.select(F.col("file").alias("_file"), F.col("page").alias("_page"), F.col("bits").alias("_bits")))
    met = docs.join(some, (F.col(file) == F.col("_file")) & (_page(F.col(ordinal)) == F.col("_page")), "left")
    tested = met.withColumn("_byte", byte).withColumn("_place", place)
    return tested.where(F.col("_bits").isNull() | ~is_set).select(*[F.col(f"`{c}`") for c in docs.columns])


def write_without(
    docs: DataFrame,
    dropped: DataFrame,
    path: str,
    file: str = "source_file",
    ordinal: str = "doc_ord",
    maps_at_once: int = MAPS_AT_ONCE,
) -> int:
    """Write ``docs`` without the dropped addresses, as Parquet below ``path``; the number of passes.

    Maps are taken in the order of (file, page), ``maps_at_once`` at a time, each with the documents from its first
    address to the next one's, so every document is in one pass. Documents written in that order, as file by file, are
    read once in all, since Parquet skips what lies elsewhere; a list that fits one pass needs no order.
    """
    maps = written(with_ordinal(ordinal_bitmaps(dropped, file, ordinal), ["file", "page"], "place"), "bitmaps")
    firsts = maps.where(F.col("place") % maps_at_once == 0).select("place", "file", "page").orderBy("place").collect()
    passes = max(1, len(firsts))
    for n in range(passes):
        part = docs
        if n:
            part = part.where((F.col(file) >= firsts[n].file) & ~_before(firsts[n], file, ordinal))
        if n + 1 < passes:
            inside = (F.col(file) <= firsts[n + 1].file) & _before(firsts[n + 1], file, ordinal)
            # The first pass also has the rows without an address.
            part = part.where(inside if n else inside | F.col(file).isNull() | F.col(ordinal).isNull())
        some = maps.where((F.col("place") >= n * maps_at_once) & (F.col("place") < (n + 1) * maps_at_once))
        kept = without_addresses(part, some, file, ordinal)
        kept.write.mode("overwrite").parquet(f"{path}/pass={n}")
    return passes


def _before(first, file: str, ordinal: str) -> Column:
    return (F.col(file) < first.file) | ((F.col(file) == first.file) & (_page(F.col(ordinal)) < first.page))
