"""Exact deduplication as a stateful stream: disk-backed state per digest, never expired, and bytes checked on hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from linkmill.llm.common import ASCII_SPACE, sieved, table
from linkmill.session import scratch_path, written, written_with
from linkmill.streaming.tables import read_batches, write_batch

#: Files of fingerprints that one micro-batch takes.
FILES_PER_BATCH = 64

#: State lives in an embedded store on disk whose native memory is bounded, and is saved as a log of changes.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Logs take the disk they need; reserving megabytes ahead would cost each of many small stores more than its state.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A stream takes the settings it starts with; the session gets its own back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    """A text without its ASCII white space; null as empty."""
    return F.coalesce(F.regexp_replace(text, ASCII_SPACE + "+", ""), F.lit(""))


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_file`` and ``_at``, the place of each row. Rows that don't come from files are written first."""
    clean = docs.drop("_file", "_at")
    for source in (lambda: clean, lambda: written(clean, "located")):
        try:
            df = source()
            meta = df.metadataColumn("_metadata")
            return df.select("*", meta["file_path"].alias("_file"), meta["row_index"].alias("_at"))
        except AnalysisException:
            continue
    raise ValueError("the rows can't be located")


def keep_state(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays and the number of rows; works on a stream (as running state) and on a table.

    The row with the most code points stays, then the one with the smallest id (null last), then the first place. The
    aggregate combines map-side, so a digest with a third of all rows reaches its state as one row per task.
    """
    order = F.struct((-F.col("n_chars")).alias("chars"), F.col("id").isNull().alias("none"), "id", "_file", "_at")
    return rows.groupBy("digest").agg(F.min(order).alias("keep"), F.count(F.lit(1)).alias("group_size"))


def stream_state(spark: SparkSession, fingerprints: str, schema, target: str, checkpoint: str, files_per_batch: int) -> StreamingQuery:
    """Feed the fingerprint files not taken yet into the state; groups that changed go to ``target``, a folder a batch.

    A replayed batch overwrites its folder. State is kept for good: there is no watermark.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(fingerprints)
    with _settings(spark, STATE_STORE):
        return (
            keep_state(rows)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, n: write_batch(batch, target, n))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """A row for each row of ``docs``: ``id, _file, _at, digest, keep, group_size, kept``.

    Texts are equal if they are the same bytes after removing ASCII white space; null counts as empty. One row of
    each group is ``kept``, also if whole rows repeat: ``keep`` holds its id and place. Other columns are not read; an
    empty table gives no rows; a very long text is one row like any other.

    1. A narrow pass writes (digest, code points, id, place); texts are not shuffled.
    2. A stream reads these files into state that is kept on disk and never expires.
    3. Rows of digests that hit more than once are read again and their bytes compared with those of the row that
       stays, found by its place. Should bytes differ, those digests are grouped by the texts themselves.
    """
    spark = docs.sparkSession
    placed = located(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")))
    narrow_path = scratch_path(spark, "digests")
    narrow, rows = written_with(
        placed.select(digest(normalised(F.col("text"))).alias("digest"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "id", "_file", "_at"),
        narrow_path,
        F.count(F.lit(1)),
    )
    updates = scratch_path(spark, "digest-updates")
    if rows:
        stream_state(spark, narrow_path, narrow.schema, updates, scratch_path(spark, "digest-state"), files_per_batch).awaitTermination()
    state = read_batches(spark, updates, keep_state(narrow).schema)
    # A group is written again by each batch that changed it; the largest count and the smallest row are the last.
    groups = written(state.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("group_size").alias("group_size")), "digest-groups")

    hits = groups.where("group_size > 1").select("digest", "keep")
    here = placed.withColumn("norm", normalised(F.col("text"))).withColumn("digest", digest(F.col("norm")))
    # Texts without a hit stay where they are. Hits grow with the rows, so they are never broadcast; a hot digest's rows
    # can be split in this join.
    sifted = sieved(here, F.xxhash64("digest"), hits.select(F.xxhash64("digest"))).where("_maybe")
    members = written(sifted.join(hits.hint("shuffle_hash"), "digest").select("digest", "norm", "keep", F.length("text").cast("long").alias("n_chars"), "id", "_file", "_at"), "digest-members")
    at_keep = (F.col("_file") == F.col("keep._file")) & (F.col("_at") == F.col("keep._at"))
    first = members.where(at_keep).select("digest", F.col("norm").alias("first"))
    # Nothing is aggregated right after this join, so the rows of a hot digest can be split in it.
    differing, collisions = written_with(
        members.join(first, "digest").where("norm <> first").select("digest"), scratch_path(spark, "collisions"), F.count(F.lit(1))
    )
    labelled = narrow.join(groups, "digest")
    if collisions:
        differing = differing.distinct()
        mixed = members.drop("keep").join(differing, "digest").withColumn("n_chars", F.coalesce("n_chars", F.lit(0).cast("long")))
        exact = mixed.withColumnRenamed("digest", "weak").withColumnRenamed("norm", "digest")
        regrouped = exact.join(keep_state(exact), "digest").select(F.col("weak").alias("digest"), "n_chars", "id", "_file", "_at", "keep", "group_size")
        labelled = labelled.join(differing, "digest", "left_anti").unionByName(regrouped)
    return labelled.select("id", "_file", "_at", "digest", "keep", "group_size", at_keep.alias("kept"))


def rows_at(docs: DataFrame, places: Callable[[DataFrame], DataFrame], how: str = "left_semi") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand at the places ``(_file, _at)`` given for them, or with
    ``left_anti`` at no such place. Rows that don't come from files are written first."""
    source = docs
    try:
        source.select(source.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        source = written(docs, "documents")
    file, at = "_place_file", "_place_at"
    while file in docs.columns or at in docs.columns:
        file, at = f"_{file}", f"_{at}"
    keys = places(source).select(F.col("_file").alias(file), F.col("_at").alias(at))
    meta = source.metadataColumn("_metadata")
    placed = source.select("*", meta["file_path"].alias(file), meta["row_index"].alias(at))
    return placed.join(keys, [file, at], how).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_groups``."""
    return rows_at(docs, lambda source: exact_groups(source, doc_id, text).where("kept"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(
        F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE = r"""
with d as (select doc_id, length(coalesce(text, '')) n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256 from documents)
select doc_id, first_value(doc_id) over w keep_id, count(*) over (partition by text_sha256) group_size,
  first_value(doc_id) over w = doc_id kept, text_sha256
from d window w as (partition by text_sha256 order by n desc, doc_id)
"""
