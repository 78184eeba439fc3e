"""File ids, document ordinals, whole-file batches and fixed-size batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.operators.ordinals import with_ordinal, with_running


def documents_per_file(docs: DataFrame, source: str = "source_file") -> DataFrame:
    return docs.groupBy(source).agg(F.count(F.lit(1)).alias("n_docs"))


def with_document_ordinal(docs: DataFrame, order: list[str], source: str = "source_file") -> DataFrame:
    """Adds ``doc_ord``, the 0-based position of a document in its file."""
    return with_ordinal(docs, order, "doc_ord", [source])


def with_file_id(files: DataFrame, source: str = "source_file") -> DataFrame:
    """Adds ``file_id``, the 0-based position of a file in name order."""
    return with_ordinal(files, [source], "file_id")


def attach_file_id(docs: DataFrame, files: DataFrame, source: str = "source_file") -> DataFrame:
    """Look up the file id of each document; a small file table is broadcast by its measured size."""
    return docs.join(files.select(source, "file_id"), source)


def pack_files(files: DataFrame, n_batches: int) -> DataFrame:
    """Adds ``batch`` to a (file_id, n_docs) table: consecutive whole files in about ``n_batches`` batches.

    A batch is closed after a file when the documents so far exceed (batch + 1) * total / n_batches, at most
    once per file. With k_i the number of whole shares covered after file i, the batch of the next file is
    min(batch_i + 1, k_i), which unrolls to running minima and needs no loop.
    """
    total = files.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).cast("bigint").alias("_total"))
    running = with_running(files, ["file_id"], {"_cum": ("sum", F.col("n_docs"))})
    exact = F.expr(f"(_cum * {int(n_batches)} - 1) div _total")
    k = F.when((F.col("_total") == 0) | (F.col("_cum") == 0), F.lit(0)).otherwise(exact)
    shares = running.withColumn("_total", total.scalar()).withColumn("_k", k.cast("bigint"))
    low = with_running(shares, ["file_id"], {"_low": ("min", F.col("_k") - F.col("file_id"))})
    nxt = low.select(
        (F.col("file_id") + 1).alias("file_id"),
        (F.col("file_id") + F.least(F.lit(1), F.col("_low"))).cast("bigint").alias("batch"),
    )
    return files.join(nxt, "file_id", "left").withColumn("batch", F.coalesce("batch", F.lit(0).cast("bigint")))


def fixed_batches(
    df: DataFrame, order: list[str], size: int, skip: int = 0, name: str = "url_batch"
) -> DataFrame:
    """Consecutive batches of exactly ``size`` rows in ``order``, leaving out the first ``skip`` rows."""
    numbered = with_ordinal(df, order, "_position")
    return (
        numbered.where(F.col("_position") >= skip)
        .withColumn(name, F.expr(f"(_position - {int(skip)}) div {int(size)}").cast("bigint"))
        .drop("_position")
    )
