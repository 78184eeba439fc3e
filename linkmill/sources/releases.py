"""Release outputs: raw and clean corpora as Parquet or JSON lines, whole or by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.sources.documents import write_documents


def write_release(
    docs: DataFrame, path: str, file_format: str = "parquet", month_of: str | None = None
) -> None:
    """Write (text, meta). With ``month_of``, a timestamp column, into month folders; the rebalance hint
    splits a large month over many tasks."""
    if month_of is None:
        if file_format == "jsonl":
            write_documents(docs, path)
        else:
            docs.write.mode("overwrite").parquet(path)
        return
    rows = docs.withColumn("month", F.date_format(month_of, "yyyy-MM"))
    rows.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path)


def first_submitted(docs: DataFrame) -> DataFrame:
    """Adds ``created``: when the page was first submitted, which decides the month of a release."""
    known = F.col("first_created") if "first_created" in docs.columns else F.array_min("meta.reddit_created_utc")
    return docs.withColumn("created", known)
