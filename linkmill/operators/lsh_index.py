"""The persistent LSH index: kept documents, clustered and sorted by bucket, grown batch by batch.

The index is a bucketed table over (band, band_key), so a batch meets it without moving it: only the batch's own rows
are shuffled, to the index's buckets. Every batch adds a file to each bucket, so from time to time all batches are
compacted into one file a bucket. All that is derived from the batch's number, so a replayed batch finds and leaves
the same index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.operators.dedup import BUCKET

#: Files of the index a batch adds, and tasks that read it. Take about its size over 256 MB; it can't change later.
INDEX_BUCKETS = 16
#: Batches between two compactions.
COMPACT_EVERY = 16


@dataclass(frozen=True)
class ClusteredIndex:
    """An index at ``path`` of documents known by ``key``, a column of the type ``key_type``.

    Batches are numbered from 0; those from ``compact_every`` * g on are generation g. It begins with a base, all
    earlier rows in one partition, numbered -g. Two generations exist at a time, at ``side=0`` and ``side=1``: a new one
    overwrites the last but one, when nothing can ask for that any more.
    """

    path: str
    key: str
    key_type: str
    buckets: int = INDEX_BUCKETS
    compact_every: int = COMPACT_EVERY

    def _table(self, spark: SparkSession, generation: int) -> str:
        """The name under which Spark knows a generation's folder and its buckets."""
        side = f"{self.path}/side={generation % 2}"
        name = f"linkmill_lsh_{hashlib.sha256(side.encode()).hexdigest()[:20]}"
        columns = f"band int, band_key string, `{self.key}` {self.key_type}, batch_id bigint"
        if not spark.catalog.tableExists(name):
            # Adds no rows, but the folder, which may be new.
            spark.createDataFrame([], columns).write.mode("append").partitionBy("batch_id").parquet(side)
            spark.sql(
                f"create table {name} ({columns}) using parquet partitioned by (batch_id) clustered by (band, band_key)"
                f" sorted by (band, band_key) into {self.buckets} buckets location '{side}'"
            )
        spark.sql(f"alter table {name} recover partitions")
        return name

    def _write(self, rows: DataFrame, table: str, batch_id: int, whole: bool = False) -> None:
        """Put rows into the table as one partition, in place of what that holds, or what the ``whole`` table holds."""
        spark = rows.sparkSession
        # One task a bucket. The same columns as they are would be no repartition to Spark if the rows come from an index,
        # and then it might not read that by bucket either.
        bucket = (F.coalesce("band", F.lit(0)), F.col("band_key"))
        clustered = rows.select("band", "band_key", self.key).repartition(self.buckets, *bucket)
        if whole:
            clustered = clustered.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        target = "batch_id" if whole else f"batch_id = {batch_id}"
        spark.sql(f"insert overwrite table {table} partition ({target}) select * from {{rows}}", rows=clustered)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """(band, band_key, key) of the documents kept by earlier batches; the first batch of a generation compacts."""
        generation = batch_id // self.compact_every
        first = generation * self.compact_every
        table = self._table(spark, generation)
        if generation and spark.table(table).where(F.col("batch_id") == -generation).isEmpty():
            self._write(self._of(spark.table(self._table(spark, generation - 1)), first - 1, first), table, -generation, whole=True)
        return self._of(spark.table(table), batch_id, batch_id)

    def _of(self, table: DataFrame, batch_id: int, stop: int) -> DataFrame:
        """Rows of the base of the batch's generation and of that generation's batches before ``stop``."""
        generation = batch_id // self.compact_every
        base = (F.col("batch_id") == -generation) & F.lit(generation > 0)
        return table.where(base | F.col("batch_id").between(generation * self.compact_every, stop - 1)).select(*BUCKET, self.key)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Add the index rows of one batch; a replay replaces them."""
        self._write(rows, self._table(rows.sparkSession, batch_id // self.compact_every), batch_id)
