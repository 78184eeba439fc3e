"""Incremental near-dedup against a persistent index of kept documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkmill.operators.dedup import duplicates, incremental_dedup
from linkmill.operators.lsh_index import COMPACT_EVERY, INDEX_BUCKETS, ClusteredIndex
from linkmill.plans.corpus import signatures
from linkmill.session import written
from linkmill.streaming.tables import write_batch


def dedup_batch(docs: DataFrame, key: str, index: ClusteredIndex, dropped: str, batch_id: int, tasks: int | None = None) -> None:
    """Run one batch: index rows of new kept documents and the duplicate list, both under the batch id. ``tasks`` as in
    ``with_signature``."""
    banded = signatures(docs, key, tasks)
    kept, new_rows = incremental_dedup(banded, index.before(docs.sparkSession, batch_id), key)
    new_rows = written(new_rows, "index-rows")
    write_batch(duplicates(banded, kept, key), dropped, batch_id)
    # The index goes last: only a finished batch may be met by later ones.
    index.add(new_rows, batch_id)


def dedup_documents(
    spark: SparkSession,
    documents: str,
    schema: T.StructType,
    key: str,
    index: str,
    dropped: str,
    checkpoint: str,
    files_per_batch: int = 64,
    buckets: int = INDEX_BUCKETS,
    compact_every: int = COMPACT_EVERY,
    tasks: int | None = None,
) -> StreamingQuery:
    """Deduplicate every document file that has not been taken yet, then stop. ``key`` must be unique over all
    batches; inside a batch it is the processing order. The index at ``index`` belongs to this checkpoint; what a
    batch shuffles does not grow with it."""
    clustered = ClusteredIndex(index, key, schema[key].dataType.simpleString(), buckets, compact_every)
    incoming = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(documents).select(key, "text")
    )
    return (
        incoming.writeStream.foreachBatch(lambda batch, n: dedup_batch(batch, key, clustered, dropped, n, tasks))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
