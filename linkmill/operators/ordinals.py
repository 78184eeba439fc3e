"""Running numbers over a global order without pulling the order through one task.

Rows are range-partitioned on the order and written once, so that every later step sees the same slices. Each
slice is numbered on its own; the few per-slice totals then give each slice its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.session import written


def sliced(df: DataFrame, order: list[str], label: str = "sliced") -> DataFrame:
    """``df`` written in ranges of ``order``, with the range number in ``_slice``."""
    return written(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_slice", F.spark_partition_id()), label
    )


def with_ordinal(
    df: DataFrame, order: list[str], name: str, within: list[str] | None = None
) -> DataFrame:
    """Adds the 0-based position of each row in ``order``, over the table or within the ``within`` columns.

    The order must be total. A group that holds much of the table spans many slices and is numbered in
    parallel; the offsets table has at most slices + groups rows.
    """
    group = within or []
    columns = [F.col(c) for c in group + order]
    # Sorted on its way to the file, so that a row's number in its slice is known when it is written: rows are
    # shuffled once, and only meet the small table of offsets afterwards.
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    rows = written(placed.withColumn("_place", F.monotonically_increasing_id()), "sliced")
    in_slice = (1 << 33) - 1
    rows = rows.withColumn("_slice", F.shiftrightunsigned("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND(F.lit(in_slice))
    )
    sizes = rows.groupBy("_slice", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", *group, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).cast("bigint").alias("_offset")
    )
    return rows.join(offsets, ["_slice", *group]).select(
        *df.columns, (F.col("_place") + F.col("_offset")).cast("bigint").alias(name)
    )


def with_running(df: DataFrame, order: list[str], scans: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds inclusive running aggregates in ``order``: ``{name: (kind, value)}``, kind ``sum`` or ``min``."""
    rows = sliced(df.select("*", *[v.alias(f"_v_{n}") for n, (_, v) in scans.items()]), order)
    fold = {"sum": F.sum, "min": F.min}
    join_up = {"sum": lambda a, b: a + F.coalesce(b, F.lit(0)), "min": lambda a, b: F.least(a, b)}
    local = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so this window without a partition is as small as the number of range partitions.
    slices = rows.groupBy("_slice").agg(*[fold[k](f"_v_{n}").alias(f"_v_{n}") for n, (k, _) in scans.items()])
    carry = slices.select(
        "_slice", *[fold[k](f"_v_{n}").over(earlier).alias(f"_c_{n}") for n, (k, _) in scans.items()]
    )
    scanned = rows.select(
        *df.columns, "_slice", *[fold[k](f"_v_{n}").over(local).alias(f"_l_{n}") for n, (k, _) in scans.items()]
    )
    return scanned.join(F.broadcast(carry), "_slice").select(
        *df.columns,
        *[join_up[k](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (k, _) in scans.items()],
    )
