"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

#: One post per line. ``created_utc`` and ``score`` are read as text because numbers come in several forms.
RAW_POST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("is_self", T.BooleanType()),
        T.StructField("url", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("created_utc", T.StringType()),
    ]
)

SUBMISSION = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("url", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("created_utc", T.TimestampNTZType()),
    ]
)

#: Metadata fields of a submission that become aligned arrays, in their published order.
META_FIELDS = ["id", "score", "title", "subreddit", "created_utc"]

URL_META = T.StructType(
    [
        T.StructField("id", T.ArrayType(T.LongType())),
        T.StructField("score", T.ArrayType(T.LongType())),
        T.StructField("title", T.ArrayType(T.StringType())),
        T.StructField("subreddit", T.ArrayType(T.StringType())),
        T.StructField("created_utc", T.ArrayType(T.TimestampNTZType())),
    ]
)

DOCUMENT_META = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("word_count", T.LongType()),
        T.StructField("elapsed", T.DoubleType()),
        T.StructField("scraper", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("reddit_id", T.ArrayType(T.LongType())),
        T.StructField("subreddit", T.ArrayType(T.StringType())),
        T.StructField("reddit_score", T.ArrayType(T.LongType())),
        T.StructField("reddit_title", T.ArrayType(T.StringType())),
        T.StructField("reddit_created_utc", T.ArrayType(T.TimestampNTZType())),
    ]
)

DOCUMENT = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("meta", DOCUMENT_META)]
)
