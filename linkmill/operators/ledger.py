"""Statistics of a growing corpus: partial sums written beside each batch, and folded when asked for.

A batch is read once, when it is written; statistics of the whole corpus are sums over the ledger, which has a few rows
per batch, so no text is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.functions.scalars import percent, scaled
from linkmill.session import written
from linkmill.streaming.tables import read_batches, write_batch

#: Sums that add up over batches, by a column of the documents (or one row for all of them).
SUMS = ("n_docs", "total_chars", "total_bytes", "n_duplicates", "n_errors")


def _schema(by: tuple[str, ...]) -> T.StructType:
    keys = [T.StructField(c, T.StringType()) for c in by]
    return T.StructType([*keys, *[T.StructField(c, T.LongType()) for c in SUMS]])


def partial_sums(docs: DataFrame, by: tuple[str, ...] = (), dropped: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """One row per group: documents, characters and bytes of their text, duplicates and failed extractions.

    ``dropped`` and ``failed`` have the columns of ``by`` too. Each is summed map-side on its own; nothing is joined.
    """
    ones = {"n_docs": F.lit(1), "total_chars": F.length("text"), "total_bytes": F.octet_length("text")}
    parts = [(docs, ones)] + [(rows, {name: F.lit(1)}) for rows, name in ((dropped, "n_duplicates"), (failed, "n_errors")) if rows is not None]
    flat = None
    for rows, values in parts:
        keys = [F.col(c).cast("string").alias(c) for c in by]
        sums = rows.select(*keys, *[values.get(c, F.lit(0)).cast("bigint").alias(c) for c in SUMS]).groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])
        flat = sums if flat is None else flat.unionByName(sums)
    return flat.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])


def add_batch(
    docs: DataFrame,
    documents: str,
    ledger: str,
    batch_id: int,
    by: tuple[str, ...] = (),
    dropped: DataFrame | None = None,
    failed: DataFrame | None = None,
) -> None:
    """Write a batch of documents and then its sums; writing it again, after a failure, replaces both.

    Sums are taken from the written batch, so they say what is there. A batch counts once its sums are written.
    """
    write_batch(docs, documents, batch_id)
    back = docs.sparkSession.read.schema(docs.schema).parquet(f"{documents}/batch_id={batch_id}")
    write_batch(written(partial_sums(back, by, dropped, failed), "sums").coalesce(1), ledger, batch_id)


def fold(spark: SparkSession, ledger: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of all batches so far, from the ledger alone: the sums, and what follows from them.

    ``by`` may leave out columns by which sums were taken.
    """
    sums = read_batches(spark, ledger, _schema(by)).groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    tried = F.col("n_docs") + F.col("n_errors")
    return sums.select(
        "*",
        scaled(F.col("total_chars"), 1e9).alias("text_gb"),
        percent(F.col("n_docs") - F.col("n_duplicates"), F.col("n_docs")).alias("useful_pct"),
        percent(F.col("n_errors"), tried).alias("error_pct"),
    )
