"""Incremental ingest of dump files: each file once, each submission id once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkmill.functions.scalars import base_name
from linkmill.operators.submissions import dedup_by_id, quarantine, to_submissions
from linkmill.schemas import SUBMISSION
from linkmill.session import written
from linkmill.sources.dumps import hash_files, read_dumps
from linkmill.streaming.keyed import first_by_key
from linkmill.streaming.tables import read_batches, write_batch

#: Files taken into one micro-batch; their names are all that reaches the driver.
FILES_PER_BATCH = 64


#: What became of each file: its digest, and ``ok``, ``unlisted``, or ``mismatch`` for a file that was set aside.
LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("actual", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def verify_batch(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """The ledger's rows of (path, length, modified), written once. Without a manifest every file is unlisted and isn't
    hashed."""
    if manifest is None:
        checked = files.withColumn("actual", F.lit(None).cast("string")).withColumn("status", F.lit("unlisted"))
    else:
        sums = hash_files(files).withColumn("file_name", base_name(F.col("path")))
        known = manifest.groupBy("file_name").agg(F.collect_set(F.lower("expected")).alias("expected"))
        status = (
            F.when(F.col("expected").isNull(), "unlisted").when(F.array_contains("expected", F.col("actual")), "ok").otherwise("mismatch")
        )
        checked = files.join(sums.join(known, "file_name", "left").select("path", "actual", status.alias("status")), "path")
    return written(checked.select(*LEDGER.fieldNames()), "verified")


def set_aside(spark: SparkSession, ledger: str) -> DataFrame:
    """The files whose last check failed, with the length and time they had."""
    rows = read_batches(spark, ledger, LEDGER)
    last = rows.groupBy("path").agg(F.max_by(F.struct("length", "modified", "status"), "modified").alias("last"))
    return last.where("last.status = 'mismatch'").select("path", "last.length", "last.modified")


def replaced(spark: SparkSession, dumps: str, ledger: str) -> DataFrame:
    """Files set aside that have changed since, as (path, length, modified)."""
    aside = set_aside(spark, ledger).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(dumps)
    now = there.select("path", "length", F.col("modificationTime").alias("modified"))
    changed = (F.col("length") != F.col("_length")) | (F.col("modified") > F.col("_modified"))
    return now.join(aside, "path").where(changed).select("path", "length", "modified")


def ingest_dumps(
    spark: SparkSession,
    dumps: str,
    table: str,
    checkpoint: str,
    quarantine_table: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    manifest: DataFrame | None = None,
) -> StreamingQuery:
    """Take every dump file that has not been taken yet into the submission table, then stop.

    The stream is the file listing, so that all codecs of ``read_dumps`` work; the checkpoint remembers the files. A
    batch of files is landed with each id once, its smallest submission; then ids of earlier batches are left out by
    the state of ``first_by_key``. So an id keeps the submission of the first batch that has it, and neither the table
    nor earlier files are read again. Landed submissions, below the checkpoint, can go when no run is under way.

    With a ``manifest`` of (file_name, expected) sums, files are verified before they are loaded. One that doesn't fit is
    set aside, which the ledger at ``ledger_of(checkpoint)`` tells; once it was replaced, the next run takes it.
    """
    landed, ledger = f"{checkpoint}/landed", ledger_of(checkpoint)
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(dumps)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )

    def load(files: DataFrame, batch_id: int) -> None:
        checked = verify_batch(files, manifest)
        paths = [row.path for row in checked.where("status <> 'mismatch'").select("path").collect()]
        if paths:
            posts = read_dumps(spark, paths)
            write_batch(dedup_by_id(to_submissions(posts)), landed, batch_id)
            first_by_key(spark, landed, SUBMISSION, "id", table, f"{checkpoint}/ids").awaitTermination()
            if quarantine_table:
                write_batch(quarantine(posts), quarantine_table, batch_id)
        # The ledger goes last: what it says has happened.
        write_batch(checked, ledger, batch_id)

    def take(batch: DataFrame, batch_id: int) -> None:
        # At most FILES_PER_BATCH names; the stream's own session isn't used for reading them.
        rows = batch.collect()
        if rows:
            load(spark.createDataFrame(rows, batch.schema), batch_id)

    changed = written(replaced(spark, dumps, ledger), "replaced")
    if not changed.isEmpty():
        # Such batches are numbered downwards from -1; one that failed half-way has no ledger entry and is run again.
        known = read_batches(spark, ledger, T.StructType([*LEDGER.fields, T.StructField("batch_id", T.LongType())]))
        load(changed, min(0, known.agg(F.min("batch_id")).first()[0] or 0) - 1)
    return (
        listing.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ledger_of(checkpoint: str) -> str:
    return f"{checkpoint}/ledger"


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, table, SUBMISSION)


def skip_done(inputs: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Batch counterpart of the checkpoint: inputs that are not on the list of processed ones."""
    return inputs.join(done.select(F.col(key)).distinct(), key, "left_anti")
