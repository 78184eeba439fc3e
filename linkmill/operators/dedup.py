"""Greedy near-duplicate removal over LSH bands.

In a given order a document is dropped if it shares a band with an earlier *kept* document, else it is kept.
This is the lexicographically first maximal independent set of the "shares a band" graph (Blelloch, Fineman and
Shun, 2012) and is found here in rounds of plain aggregations and joins, never from pairs of documents.

A bucket is one (band, key). Buckets may be arbitrarily large, so
* documents with all bands equal are first reduced to their earliest copy, which combines map-side;
* bucket facts are aggregates (minimum, count), which combine map-side as well;
* facts go back to documents through a broadcast for the few huge buckets and a shuffle for the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.session import scratch_path, written, written_with

#: At most this many buckets are broadcast; any other bucket is then no larger than rows / MAX_HOT_BUCKETS
#: or HOT_BUCKET_ROWS.
MAX_HOT_BUCKETS = 20_000
HOT_BUCKET_ROWS = 200_000

BUCKET = ["band", "band_key"]


def band_rows(banded: DataFrame, key: str, *more: str) -> DataFrame:
    """(key, band, band_key): one row per document and band.

    The outer form, because the plain one makes the optimizer compute the bands a second time in a filter.
    """
    return banded.select(key, *more, F.posexplode_outer("bands").alias("band", "band_key"))


def spread_bucket_facts(
    edges: DataFrame, facts: DataFrame, n_edges: int, hot_rows: int = HOT_BUCKET_ROWS
) -> DataFrame:
    """Inner join of document rows with one fact row per bucket (``facts`` has the bucket size in ``n``).

    Buckets above the limit number at most MAX_HOT_BUCKETS, because the limit is at least
    n_edges / MAX_HOT_BUCKETS, so broadcasting them is safe at any size; the rest join by shuffle with
    bounded groups.
    """
    limit = max(hot_rows, n_edges // MAX_HOT_BUCKETS)
    if n_edges <= limit:
        return edges.join(facts, BUCKET)
    facts = written(facts, "bucket-facts")
    hot = facts.where(F.col("n") > limit)
    if hot.isEmpty():
        return edges.join(facts, BUCKET)
    huge = edges.join(F.broadcast(hot), BUCKET)
    others = edges.join(F.broadcast(hot.select(*BUCKET)), BUCKET, "left_anti")
    return huge.unionByName(others.join(facts.where(F.col("n") <= limit), BUCKET))


def _earliest_copies(banded: DataFrame, key: str) -> DataFrame:
    """One document per distinct signature: copies share every band with the earliest one and follow its fate
    or are dropped because of it."""
    return banded.groupBy("bands").agg(F.min(key).alias(key))


def greedy_keep(banded: DataFrame, key: str, hot_rows: int = HOT_BUCKET_ROWS) -> DataFrame:
    """The kept documents, as one column ``key``, from (key, bands); order is ascending ``key``.

    ``key`` must be unique: a number, text, or a struct such as (file_id, doc_ord). The rounds end when no
    document is undecided. The first undecided document is decided in every round, so they always end.
    """
    spark = banded.sparkSession
    copies = _earliest_copies(banded.select(key, "bands"), key)
    unique, n_edges = written_with(copies, scratch_path(spark, "unique"), F.sum(F.size("bands")))
    edges = band_rows(unique, key)

    # Buckets of one document decide nothing, and a document with only such buckets is kept.
    sizes = edges.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    state = (
        spread_bucket_facts(edges, sizes, n_edges, hot_rows)
        .groupBy(key)
        .agg(F.collect_list(F.struct(*BUCKET)).alias("buckets"))
        .withColumn("status", F.lit("open"))
    )
    base, paths = scratch_path(spark, "rounds"), []
    while True:
        paths.append(f"{base}/round={len(paths)}")
        state, n_open = written_with(state, paths[-1], F.count_if(F.col("status") == "open"))
        if n_open == 0:
            break
        undecided = state.where(F.col("status") == "open").select(key, "buckets")
        state = _one_round(undecided, key, n_edges, hot_rows)
    rounds = spark.read.schema(f"{_ddl(unique, key)}, status string").parquet(*paths)
    return unique.select(key).join(rounds.where(F.col("status") == "dropped").select(key), key, "left_anti")


def count_edges(banded: DataFrame) -> int:
    return banded.agg(F.coalesce(F.sum(F.size("bands")), F.lit(0)).alias("n")).first().n


def _ddl(df: DataFrame, column: str) -> str:
    return f"`{column}` {df.schema[column].dataType.simpleString()}"


def _one_round(undecided: DataFrame, key: str, n_edges: int, hot_rows: int) -> DataFrame:
    """Decide every undecided document that is earliest in all its buckets, and the documents it displaces."""
    edges = undecided.select(key, F.size("buckets").alias("degree"), F.inline("buckets"))
    firsts = edges.groupBy(*BUCKET).agg(
        F.min(key).alias("first"), F.min_by("degree", key).alias("first_degree"), F.count(F.lit(1)).alias("n")
    )
    # A document has few buckets, so this window has no large group.
    of_first = Window.partitionBy("first")
    taken = F.count(F.lit(1)).over(of_first) == F.col("first_degree")
    facts = firsts.withColumn("taken", taken).drop("first_degree")
    told = spread_bucket_facts(edges, facts, n_edges, hot_rows)
    by_other = F.col("taken") & (F.col("first") != F.col(key))
    return (
        told.groupBy(key)
        .agg(
            F.max(by_other).alias("_dropped"),
            F.max("taken").alias("_decided"),
            F.collect_list(F.struct(*BUCKET)).alias("buckets"),
        )
        .select(
            key,
            "buckets",
            F.when(F.col("_dropped"), "dropped").when(F.col("_decided"), "kept").otherwise("open").alias("status"),
        )
    )


def duplicates(banded: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The dropped documents: everything that was not kept."""
    return banded.select(key).join(kept.select(key), key, "left_anti")


def apply_duplicates(docs: DataFrame, dropped: DataFrame, address: list[str]) -> DataFrame:
    """The documents whose address is not on the duplicate list."""
    return docs.join(dropped.select(*address), address, "left_anti")


def union_duplicates(*lists: DataFrame) -> DataFrame:
    """Set union of duplicate lists."""
    return reduce(DataFrame.unionByName, lists).distinct()


# --- the persisted index -------------------------------------------------------------------------------------


def index_rows(banded: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(band, band_key, key) of the kept documents. Kept documents share no bucket, so a bucket has one row."""
    return band_rows(banded.join(kept.select(key), key, "left_semi"), key).select(*BUCKET, key)


def _bucket_hits(
    banded: DataFrame, index: DataFrame, key: str, hot_rows: int = HOT_BUCKET_ROWS, n_edges: int | None = None
) -> DataFrame:
    """(key, found): each document with the *indexed* documents it shares a band with, itself included; a row for each
    band they share.

    The index is met by one row per bucket of the batch, so it is read once, and it is not shuffled if it is clustered
    by bucket.
    """
    edges = band_rows(banded, key)
    sizes = edges.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n"))
    facts = sizes.join(index.select(*BUCKET, F.col(key).alias("found")), BUCKET)
    hits = spread_bucket_facts(edges, facts, count_edges(banded) if n_edges is None else n_edges, hot_rows)
    return hits.select(key, "found")


def lsh_candidates(
    banded: DataFrame, index: DataFrame, key: str, hot_rows: int = HOT_BUCKET_ROWS, n_edges: int | None = None
) -> DataFrame:
    """(key, found): each document with the *indexed* documents it shares a band with, itself excluded.

    ``banded`` should be a written table, it is read more than once. An index of kept documents has one document
    per bucket, so a document gets at most as many rows as it has bands, however large the buckets of the queried
    side are.
    """
    hits = _bucket_hits(banded, index, key, hot_rows, n_edges)
    return hits.where(F.col("found") != F.col(key)).distinct()


def incremental_dedup(
    banded: DataFrame, index: DataFrame, key: str, hot_rows: int = HOT_BUCKET_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(kept documents, new index rows) of one batch against an index of earlier kept documents.

    A document already in the index stays kept and is not added again. Of the others, those that share a band
    with the index are dropped and the rest goes through the greedy rounds. A document of the index meets itself in
    every band, so one read of the index tells both. ``banded`` should be a written table, it is read more than once.
    """
    hits = _bucket_hits(banded, index, key, hot_rows)
    met = written(hits.groupBy(key).agg(F.max(F.col("found") == F.col(key)).alias("known")), "batch-met")
    candidates = written(banded.join(met.select(key), key, "left_anti"), "batch-candidates")
    new = greedy_keep(candidates, key, hot_rows)
    kept = met.where("known").select(key).unionByName(new)
    return kept, index_rows(candidates, new, key)
