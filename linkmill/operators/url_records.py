"""Submissions to one record per URL, with aligned metadata arrays and a minimum total score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.schemas import META_FIELDS

MIN_SCORE = 3

#: Metadata entries one row may hold. A URL with more is spread over several rows, numbered by ``part``.
MAX_META_PER_ROW = 1_000_000


def aligned_meta(entries: Column) -> Column:
    """An array of metadata structs as a struct of aligned arrays."""
    return F.struct(*[entries[f].alias(f) for f in META_FIELDS])


def url_totals(submissions: DataFrame, min_score: int | None = MIN_SCORE) -> DataFrame:
    """(url, n_submissions, total_score): counts and sums only, combined map-side."""
    totals = submissions.groupBy("url").agg(
        F.count(F.lit(1)).alias("n_submissions"), F.sum(F.coalesce("score", F.lit(0))).alias("total_score")
    )
    return totals if min_score is None else totals.where(F.col("total_score") >= min_score)


def build_url_records(
    submissions: DataFrame, min_score: int | None = MIN_SCORE, max_meta_per_row: int = MAX_META_PER_ROW
) -> DataFrame:
    """(url, part, total_score, first_created, meta): all metadata of a URL, ordered by id, if its total score is high
    enough.

    Almost every URL is one row with ``part`` 0. URLs with more than ``max_meta_per_row`` submissions are found
    by a counting pass and split by a hash of the id, so that no task ever holds a whole hot URL. Total score and first
    submission are of the whole URL in every part. Spark broadcasts the list of hot URLs only if it is small.
    """
    totals = submissions.groupBy("url").agg(
        F.count(F.lit(1)).alias("n_submissions"),
        F.sum(F.coalesce("score", F.lit(0))).alias("total_score"),
        F.min("created_utc").alias("first_created"),
    )
    hot = (
        totals
        .where(F.col("n_submissions") > max_meta_per_row)
        .select(
            "url",
            F.ceil(F.col("n_submissions") / F.lit(max_meta_per_row)).alias("_parts"),
            F.col("total_score").alias("_hot_total"),
            F.col("first_created").alias("_hot_first"),
        )
    )
    part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"), F.lit(0))
    entry = F.struct(
        F.col("id"),
        F.coalesce("score", F.lit(0)).alias("score"),
        *[F.col(f) for f in META_FIELDS if f not in ("id", "score")],
    )
    grouped = (
        submissions.join(hot, "url", "left")
        .groupBy("url", part.alias("part"))
        .agg(
            F.sort_array(F.collect_list(entry)).alias("_entries"),
            F.sum(F.coalesce("score", F.lit(0))).alias("_sum"),
            F.max("_hot_total").alias("_hot_total"),
            F.coalesce(F.max("_hot_first"), F.min("created_utc")).alias("first_created"),
        )
        .withColumn("total_score", F.coalesce("_hot_total", "_sum"))
    )
    if min_score is not None:
        grouped = grouped.where(F.col("total_score") >= min_score)
    return grouped.select("url", "part", "total_score", "first_created", aligned_meta(F.col("_entries")).alias("meta"))


def merge_url_records(
    *runs: DataFrame, min_score: int | None = MIN_SCORE, max_meta_per_row: int = MAX_META_PER_ROW
) -> DataFrame:
    """Combine URL records made over different periods: entries are pooled by id, the total is taken again.

    The runs must come from ``build_url_records`` with ``min_score=None``: a URL below the minimum in each
    period may reach it over all of them.
    """
    flat = None
    for run in runs:
        rows = run.select("url", F.explode(F.arrays_zip(*[f"meta.{f}" for f in META_FIELDS])).alias("e")).select(
            "url", *[F.col(f"e.{f}").alias(f) for f in META_FIELDS]
        )
        flat = rows if flat is None else flat.unionByName(rows)
    pooled = flat.groupBy("id").agg(
        F.min(F.struct("created_utc", "url", "score", "title", "subreddit")).alias("s")
    )
    return build_url_records(pooled.select("id", "s.*"), min_score, max_meta_per_row)


def meta_total(scores: Column) -> Column:
    """Sum of an array inside a row; null entries count 0, an empty or missing array gives 0."""
    total = F.aggregate(
        scores, F.lit(0).cast("bigint"), lambda acc, s: acc + F.coalesce(s, F.lit(0)).cast("bigint")
    )
    return F.coalesce(total, F.lit(0).cast("bigint"))
