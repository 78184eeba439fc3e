"""Incremental extraction of page files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkmill.operators.documents import attach_url_meta, one_per_url, successful
from linkmill.operators.extract import Extractor, article_extractor, extract
from linkmill.session import written
from linkmill.streaming.tables import write_batch

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def extract_batch(
    pages: DataFrame,
    documents: str,
    batch_id: int,
    extractor: Extractor,
    records: DataFrame | None,
    outcomes: str | None,
) -> None:
    """One batch: its documents, and what became of each of its pages, both under the batch id."""
    done = written(extract(pages, extractor), "extracted")
    if outcomes:
        write_batch(done.select("url", "success", "reason", "error"), outcomes, batch_id)
    found = one_per_url(successful(done))
    rows = found if records is None else attach_url_meta(found, records)
    # Documents go last: a batch that has them is finished.
    write_batch(rows, documents, batch_id)


def extract_pages(
    spark: SparkSession,
    pages: str,
    documents: str,
    checkpoint: str,
    extractor: Extractor = article_extractor,
    files_per_batch: int = 64,
    records: DataFrame | None = None,
    outcomes: str | None = None,
) -> StreamingQuery:
    """Extract every page file that has not been taken yet into the documents folder, then stop.

    With ``records`` documents carry their URL's metadata and total score, as in a batch run; each batch reads the
    records again. ``outcomes`` names a folder for (url, success, reason, error) of every page, by ``batch_id``, from
    which ``failures_by_batch`` counts. A batch that is replayed after a failure overwrites what it wrote before.
    """
    incoming = (
        spark.readStream.schema(PAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(pages)
    )
    return (
        incoming.writeStream.foreachBatch(
            lambda batch, n: extract_batch(batch, documents, n, extractor, records, outcomes)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
