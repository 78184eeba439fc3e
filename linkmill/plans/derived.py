"""The stage inputs of the corpus, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions.scalars import long_to_base36


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed posts: every event links to the page its user number leads to."""
    site = pages(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return (
        events.withColumn("page_id", F.col("user_id") % site.agg(F.count(F.lit(1))).scalar())
        .join(site.select("page_id", "url"), "page_id")
        .select(
            F.col("event_id").alias("id"),
            "url",
            (F.floor("value").cast("bigint") - 10).alias("score"),
            F.concat_ws(" ", kind, F.col("event_id").cast("string")).alias("title"),
            kind.alias("subreddit"),
            F.date_trunc("second", "ts").cast("timestamp_ntz").alias("created_utc"),
            F.when(kind == "error", F.lit(None)).otherwise(kind == "signup").alias("is_self"),
        )
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).where(~F.col("is_self")).drop("is_self")


def order_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions spread over several years: every order is a link to its customer's page."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("http://shop.example.com/customer/"), F.col("o_custkey").cast("string")).alias("url"),
        (F.floor(F.col("o_totalprice") / 10000).cast("bigint") - 20).alias("score"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("subreddit"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_utc"),
    )


def post_lines(typed: DataFrame) -> DataFrame:
    """Posts as dump lines: base36 ids, epoch seconds as text, missing keys left out; ``kind`` is kept beside."""
    epoch = F.unix_seconds(F.col("created_utc").cast("timestamp")).cast("string")
    line = F.to_json(
        F.struct(
            long_to_base36(F.col("id")).alias("id"),
            "is_self",
            "url",
            "score",
            "title",
            "subreddit",
            epoch.alias("created_utc"),
        )
    )
    return typed.select(line.alias("value"), F.col("subreddit").alias("kind"))


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): page URLs turned into every shape the URL checks tell apart, by page number."""
    shape = F.col("page_id") % 12
    num = F.col("page_id").cast("string")
    url = F.col("url")
    changed = (
        F.when(shape == 1, F.concat(F.lit("https://i.imgur.com/"), num))
        .when(shape == 2, F.concat(url, F.lit(".PNG?x=1")))
        .when(shape == 3, F.concat(url, F.lit(" x")))
        .when(shape == 4, F.substring_index(url, "//", -1))
        .when(shape == 5, F.lit("http://a"))
        .when(shape == 6, F.concat(F.lit("https://www.itunes.apple.com/"), num))
        .when(shape == 7, F.concat(F.lit("https://ITUNES.apple.com/"), num))
        .when(shape == 8, F.concat(F.lit("https://1.2.3.4:80/"), num))
        .when(shape == 9, F.concat(F.lit("https://user@News.Site.co.uk:8080/"), num, F.lit("?f=b.png")))
        .when(shape == 10, F.concat(F.lit("http://host-"), num, F.lit(".zip")))
        .when(shape == 11, F.concat(F.lit("https://example.org/"), num, F.lit("/a.png#top")))
        .otherwise(url)
    )
    return pages(spark, sf_dir).select("page_id", changed.alias("url"), "html")


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, part, text, meta, total_score): each document takes the submission scores of one page URL, as its
    metadata; parts as in ``attach_url_meta``."""
    from linkmill.operators.url_records import build_url_records

    site = pages(spark, sf_dir)
    docs = documents(spark, sf_dir).withColumn(
        "page_id", F.col("doc_id") % site.agg(F.count(F.lit(1))).scalar()
    )
    records = build_url_records(submissions(spark, sf_dir), min_score=None)
    by_page = site.select("page_id", "url").join(
        records.select("url", "part", "total_score", "meta.score", "meta.id"), "url", "left"
    )
    return docs.join(by_page, "page_id").select(
        "doc_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.when(F.coalesce("part", F.lit(0)) == 0, F.col("text")).alias("text"),
        F.coalesce("total_score", F.lit(0)).alias("total_score"),
        F.struct("lang", "url", F.col("id").alias("reddit_id"), F.col("score").alias("reddit_score")).alias("meta"),
    )
