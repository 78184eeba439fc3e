"""First row of every key over a growing table, with the keys as state on disk that never expires."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkmill.streaming.tables import write_batch

#: Keys live in an embedded store on each executor's disk, with bounded memory, and are saved as a log of changes.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A stream keeps the settings it starts with; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def first_by_key(
    spark: SparkSession, landed: str, schema: T.StructType, key: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Take the files landed since the last run into the table, without rows whose key it has, then stop.

    A key is looked up in the state of its own partition, so nothing reads the table again, and what a run costs grows
    with its new rows. Of rows with one key in the same run any one stays; ``landed`` should have each key once a run.
    A replayed batch overwrites its folder. Files that were landed again, under other names, add nothing: their
    predecessors may be missing.
    """
    rows = spark.readStream.schema(schema).option("ignoreMissingFiles", "true").parquet(landed)
    with settings(spark, ON_DISK):
        return (
            rows.dropDuplicates([key])
            .writeStream.foreachBatch(lambda batch, n: write_batch(batch, table, n))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
