"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions.scalars import percent, scaled


def corpus_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: documents, characters, bytes, size in GB (of characters, as published)."""
    chars, size = F.sum(F.length(text).cast("bigint")), F.sum(F.octet_length(text).cast("bigint"))
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(chars, F.lit(0)).alias("total_chars"),
        F.coalesce(size, F.lit(0)).alias("total_bytes"),
    ).withColumn("text_gb", scaled(F.col("total_chars"), 1e9))


def duplicate_stats(n_docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """One row: documents, duplicates, useful share in percent. ``n_docs`` has one row and column ``n_docs``."""
    found = dropped.agg(F.count(F.lit(1)).alias("n_duplicates"))
    return n_docs.select("n_docs", found.scalar().alias("n_duplicates")).withColumn(
        "useful_pct", percent(F.col("n_docs") - F.col("n_duplicates"), F.col("n_docs"))
    )


def release_table(releases: dict[str, DataFrame], text: str = "text") -> DataFrame:
    """One row per release, with its share of the first one."""
    table = None
    for name, docs in releases.items():
        row = corpus_stats(docs, text).withColumn("release", F.lit(name))
        table = row if table is None else table.unionByName(row)
    first = next(iter(releases))
    # One row per release, so the window without a partition is harmless and every release is read once.
    of_first = lambda c: F.max(F.when(F.col("release") == first, F.col(c))).over(Window.partitionBy())
    return table.select(
        "release",
        "n_docs",
        "total_chars",
        "total_bytes",
        percent(F.col("n_docs"), of_first("n_docs")).alias("docs_pct"),
        percent(F.col("total_chars"), of_first("total_chars")).alias("chars_pct"),
    )


def url_counts(batched: DataFrame, batch: str = "url_batch") -> DataFrame:
    """(batch, n_urls); the total is their sum. A URL spread over several rows counts once, by its first."""
    return batched.where(F.col("part") == 0).groupBy(batch).agg(F.count(F.lit(1)).alias("n_urls"))
