"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as a Java regex class: space and \t \n \v \f \r.
ASCII_SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` would also change other letters."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def once(value: Column, body) -> Column:
    """``body`` applied to ``value``, evaluated one time: a lambda variable is not inlined by the optimizer."""
    return F.transform(F.array(value), body)[0]


#: Bits of a sieve, 1 MB at any number of keys.
SIEVE_BITS = 1 << 23


def sieved(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false only if ``key``, a long, is none of those in the one column of ``keys``.

    A bit map of fixed size: 256 rows of 4 KB are broadcast, however many keys there are. What fails needn't be shuffled to
    them; with more than a few million keys most rows pass, and the join behind it is as before.
    """
    bit = lambda c: F.pmod(c, F.lit(SIEVE_BITS)) + 1  # noqa: E731  # buckets begin with number 1
    known = bit(F.col(keys.columns[0]))
    pages = keys.groupBy(F.bitmap_bucket_number(known).alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(known)).alias("_bits"))
    met = rows.join(F.broadcast(pages), F.bitmap_bucket_number(bit(key)) == F.col("_page"), "left")
    place = F.bitmap_bit_position(bit(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return met.withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_page", "_bits")
