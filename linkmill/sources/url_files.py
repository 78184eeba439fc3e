"""URL records as numbered files of a fixed size, and a stored count beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from linkmill.operators.batching import fixed_batches
from linkmill.operators.url_records import meta_total
from linkmill.schemas import URL_META
from linkmill.session import written
from linkmill.sources.documents import document_lines, read_documents, write_named_documents

# Fixed value: URLs per file.
URLS_PER_FILE = 100_000


def number_url_batches(records: DataFrame, urls_per_file: int = URLS_PER_FILE) -> DataFrame:
    """Adds ``url_batch``: consecutive batches of exactly ``urls_per_file`` URLs in url order.

    Parts of a URL that is spread over several rows stay in one batch: URLs are numbered, not rows.
    """
    numbered = fixed_batches(records.where("part = 0").select("url"), ["url"], urls_per_file)
    return records.join(numbered, "url")


def batch_file_name(prefix: str, batch: str = "url_batch") -> Column:
    """Fixed format of file names: ``urls_0.jsonl.zst``, ``scrapes_0.jsonl.zst`` and so on. Further parts of often
    submitted URLs go to files of their own, ``urls_0.part1.jsonl.zst``, so that no task writes a whole hot URL."""
    further = F.when(F.col("part") > 0, F.concat(F.lit(".part"), F.col("part").cast("string"))).otherwise("")
    return F.concat(F.lit(f"{prefix}_"), F.col(batch).cast("string"), further, F.lit(".jsonl.zst"))


def _file_rows(records: DataFrame, *extra: Column) -> DataFrame:
    """(text, meta): the URL, and its metadata with what the arrays of one part can't tell."""
    facts = [F.col(c) for c in ("part", "total_score", "first_created")]
    return records.select(F.col("url").alias("text"), F.struct("meta.*", *facts).alias("meta"), *extra)


def write_url_batches(records: DataFrame, path: str, urls_per_file: int = URLS_PER_FILE) -> None:
    """``urls_{n}.jsonl.zst`` files of exactly ``urls_per_file`` URLs in url order: one URL per line as text, and
    its metadata as meta."""
    stored = written(records, "url-records")
    batched = number_url_batches(stored, urls_per_file)
    write_named_documents(_file_rows(batched, batch_file_name("urls").alias("file_name")), path)


def write_url_files(records: DataFrame, path: str, urls_per_file: int = URLS_PER_FILE) -> None:
    """The same without exact batches: files of at most ``urls_per_file`` lines, with no ordering shuffle."""
    lines = document_lines(_file_rows(records))
    lines.write.mode("overwrite").option("maxRecordsPerFile", urls_per_file).text(path, compression="gzip")


def read_url_files(spark: SparkSession, path: str) -> DataFrame:
    """(url, part, total_score, first_created, meta, source_file): the records of all URL files below ``path``, as they
    were written. Files without the facts of the whole URL have one row per URL, whose arrays give them."""
    facts = [T.StructField("part", T.IntegerType()), T.StructField("total_score", T.LongType()), T.StructField("first_created", T.TimestampNTZType())]
    docs = read_documents(spark, path, pattern="*.{zst,gz}", meta_schema=T.StructType([*URL_META.fields, *facts]))
    return docs.select(
        F.col("text").alias("url"),
        F.coalesce("meta.part", F.lit(0)).alias("part"),
        F.coalesce("meta.total_score", meta_total(F.col("meta.score"))).alias("total_score"),
        F.coalesce("meta.first_created", F.array_min("meta.created_utc")).alias("first_created"),
        F.struct(*[F.col(f"meta.{f.name}") for f in URL_META.fields]).alias("meta"),
        "source_file",
    )


def stored_count(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """One row ``n``: read from ``path`` if it was stored there before, else counted and stored."""
    try:
        return spark.read.schema("n bigint").json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    written(rows.agg(F.count(F.lit(1)).alias("n")), "count").coalesce(1).write.json(path)
    return spark.read.schema("n bigint").json(path)
