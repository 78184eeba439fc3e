"""The submission table: Parquet by month, and a tab-separated source."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.functions.scalars import epoch_to_ntz
from linkmill.operators.submissions import dedup_by_id, in_period
from linkmill.schemas import SUBMISSION


def write_submissions(submissions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per id, in month folders. The rebalance hint lets a task write few months, and splits a month that
    holds much of the data over many tasks."""
    rows = dedup_by_id(submissions).withColumn("month", F.date_format("created_utc", "yyyy-MM"))
    rows.hint("rebalance", "month").write.mode(mode).partitionBy("month").parquet(path)


def scan_submissions(
    spark: SparkSession,
    path: str,
    start: datetime.datetime | None = None,
    end: datetime.datetime | None = None,
    now: datetime.datetime | None = None,
) -> DataFrame:
    """The six columns, optionally of whole months; other months are pruned as folders. Unordered: sort by url
    only where the order itself is the result."""
    by_month = T.StructType([*SUBMISSION.fields, T.StructField("month", T.StringType())])
    table = spark.read.schema(by_month).parquet(path)
    return in_period(table, start, end, now).select(*SUBMISSION.fieldNames())


def read_submissions_tsv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated submissions, columns in schema order, epoch or ISO times; no date range."""
    raw = spark.read.schema(
        "id bigint, url string, score bigint, title string, subreddit string, created_utc string"
    ).csv(paths, sep="\t", quote="", escape="")
    as_time = F.coalesce(epoch_to_ntz(F.col("created_utc")), F.col("created_utc").try_cast("timestamp_ntz"))
    return raw.withColumn("created_utc", as_time)


def write_submissions_tsv(submissions: DataFrame, path: str) -> None:
    """The same layout; tabs and line breaks inside values become spaces."""
    clean = lambda c: F.regexp_replace(F.col(c), r"[\t\r\n]+", " ").alias(c)
    rows = submissions.select(
        "id",
        clean("url"),
        "score",
        clean("title"),
        clean("subreddit"),
        F.date_format("created_utc", "yyyy-MM-dd'T'HH:mm:ss").alias("created_utc"),
    )
    rows.write.mode("overwrite").csv(path, sep="\t", quote="", escape="")
