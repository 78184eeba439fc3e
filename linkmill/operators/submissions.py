"""Posts to submissions: projection, filters, quarantine and exact dedup on id."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions.scalars import base36_to_long, epoch_to_ntz, next_month
from linkmill.schemas import SUBMISSION

FIRST_MONTH = datetime.datetime(2005, 6, 1)


def is_link_post() -> Column:
    """``is_self`` present and false; a missing flag is not a link post."""
    return F.coalesce(~F.col("is_self"), F.lit(False))


def has_url() -> Column:
    return F.coalesce(F.col("url") != "", F.lit(False))


def link_posts(posts: DataFrame) -> DataFrame:
    return posts.where(is_link_post() & has_url())


def _project(posts: DataFrame, extra: list[str]) -> DataFrame:
    return posts.select(
        base36_to_long(F.col("id")).alias("id"),
        "url",
        # Whole or not, as text or number; what is no number counts as missing.
        F.coalesce(F.col("score").try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0)).alias("score"),
        "title",
        "subreddit",
        epoch_to_ntz(F.col("created_utc")).alias("created_utc"),
        *extra,
    )


def to_submissions(posts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Link posts as typed submissions; posts whose id or time cannot be read are left to ``quarantine``."""
    good = posts.where(F.col("_corrupt_record").isNull()) if "_corrupt_record" in posts.columns else posts
    rows = _project(link_posts(good), keep or [])
    return rows.where(F.col("id").isNotNull() & F.col("created_utc").isNotNull())


def quarantine(posts: DataFrame) -> DataFrame:
    """Every line that cannot become a submission although it should: broken JSON, or a link post without a
    readable id or time. Adds ``reason``; together with ``to_submissions`` no line is lost."""
    broken = (
        F.col("_corrupt_record").isNotNull() if "_corrupt_record" in posts.columns else F.lit(False)
    )
    reason = (
        F.when(broken, F.lit("bad_json"))
        .when(~(is_link_post() & has_url()), F.lit(None))
        .when(base36_to_long(F.col("id")).isNull(), F.lit("bad_id"))
        .when(epoch_to_ntz(F.col("created_utc")).isNull(), F.lit("bad_created_utc"))
    )
    return posts.withColumn("reason", reason).where(F.col("reason").isNotNull())


def dedup_by_id(submissions: DataFrame) -> DataFrame:
    """One row per id, the smallest in (created_utc, url, score, title, subreddit) order.

    A plain aggregate, so copies of one id meet map-side before the shuffle, however many there are.
    """
    order = ["created_utc", "url", "score", "title", "subreddit"]
    first = F.min(F.struct(*order)).alias("_first")
    return (
        submissions.groupBy("id")
        .agg(first)
        .select("id", *[F.col(f"_first.{c}").alias(c) for c in ("url", "score", "title", "subreddit", "created_utc")])
    )


def in_period(
    submissions: DataFrame,
    start: datetime.datetime | None = None,
    end: datetime.datetime | None = None,
    now: datetime.datetime | None = None,
) -> DataFrame:
    """Half-open range of whole months, ``start`` to the month of ``end`` inclusive.

    Without both nothing is filtered. A missing start is the first known month, a missing end the month of
    ``now``. A plain range on ``created_utc``, and on ``month`` where the table has that partition column.
    """
    if start is None and end is None:
        return submissions
    low = start or FIRST_MONTH
    last = end or now or datetime.datetime.now()
    high = next_month(datetime.datetime(last.year, last.month, 1))
    bound = lambda d: F.to_timestamp_ntz(F.lit(d.strftime("%Y-%m-%d %H:%M:%S")))
    rows = submissions.where((F.col("created_utc") >= bound(low)) & (F.col("created_utc") < bound(high)))
    if "month" in submissions.columns:
        rows = rows.where(F.col("month").between(low.strftime("%Y-%m"), last.strftime("%Y-%m")))
    return rows


def conform(df: DataFrame) -> DataFrame:
    """Select and cast to the submission schema; lets any source with the six columns feed the corpus."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUBMISSION.fields])
