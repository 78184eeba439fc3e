"""Documents and their metadata: joining, renaming, filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.functions.scalars import has_text
from linkmill.functions.text import tokens
from linkmill.operators.url_records import meta_total

MIN_SCORE = 3

# Names of the submission metadata inside a document.
RENAMED_META = {
    "id": "reddit_id",
    "subreddit": "subreddit",
    "score": "reddit_score",
    "title": "reddit_title",
    "created_utc": "reddit_created_utc",
}


def successful(extracted: DataFrame) -> DataFrame:
    """Extractions that succeeded and have visible text."""
    return extracted.where(F.col("success") & has_text(F.col("text")))


def one_per_url(extracted: DataFrame) -> DataFrame:
    """One (url, text, meta) per URL: of several fetches of a page the longest text, then the last in order."""
    best = F.max(F.struct(F.length("text").alias("n"), "text", "meta")).alias("best")
    return extracted.groupBy("url").agg(best).select("url", "best.text", "best.meta")


def attach_url_meta(extracted: DataFrame, records: DataFrame) -> DataFrame:
    """(url, part, text, meta, total_score, first_created): the page metadata with the URL's submission arrays, renamed.

    A document is the row with ``part`` 0, which has the text. A URL whose arrays are spread over several rows has
    them all here: the further rows carry their part of the arrays, the same page metadata, and no text. Total score
    and first submission are those of the whole URL in each row.
    """
    total = F.col("total_score") if "total_score" in records.columns else meta_total(F.col("meta.score"))
    part = F.col("part") if "part" in records.columns else F.lit(0)
    created = F.col("first_created") if "first_created" in records.columns else F.array_min("meta.created_utc")
    by_url = records.select(
        "url", part.alias("part"), F.col("meta").alias("_url_meta"), total.alias("total_score"), created.alias("first_created")
    )
    joined = extracted.join(by_url, "url").withColumn("text", F.when(F.col("part") == 0, F.col("text")))
    own = [f.name for f in extracted.schema["meta"].dataType.fields if f.name not in RENAMED_META.values()]
    fields = [F.col(f"meta.{n}").alias(n) for n in own]
    fields += [F.col(f"_url_meta.{old}").alias(new) for old, new in RENAMED_META.items()]
    return joined.select("url", "part", "text", F.struct(*fields).alias("meta"), "total_score", "first_created")


def with_text(docs: DataFrame) -> DataFrame:
    """The rows that are documents: without the further parts of often submitted URLs."""
    return docs.where(F.col("part") == 0) if "part" in docs.columns else docs


def legacy_scores(docs: DataFrame) -> Column:
    """The score array, under its current name or the older ``reddit_scores``."""
    meta = docs.schema["meta"].dataType
    names = [n for n in ("reddit_score", "reddit_scores") if isinstance(meta, T.StructType) and n in meta.fieldNames()]
    if isinstance(meta, T.StringType):
        read = F.from_json("meta", "reddit_score array<bigint>, reddit_scores array<bigint>")
        return F.coalesce(read["reddit_score"], read["reddit_scores"])
    return F.coalesce(*[F.col(f"meta.{n}") for n in names])


def min_total_score(docs: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """Documents whose summed scores reach the minimum. An empty or missing array sums to 0.

    A column ``total_score`` is used where there is one: it also counts entries kept outside the document.
    """
    total = F.col("total_score") if "total_score" in docs.columns else meta_total(legacy_scores(docs))
    return docs.where(total >= min_score)


def in_languages(docs: DataFrame, langs: list[str], column: str = "meta.lang") -> DataFrame:
    return docs.where(F.col(column).isin(langs))


def min_tokens(docs: DataFrame, n: int = 128, text: str = "text") -> DataFrame:
    """Documents of at least ``n`` word tokens."""
    return docs.where(F.size(tokens(F.col(text))) >= n)
