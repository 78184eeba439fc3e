"""The registered queries: every operator over the given tables, as ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions import html as H
from linkmill.functions import scalars as S
from linkmill.functions import text as X
from linkmill.functions import urls as U
from linkmill.operators import batching, bitmaps, dedup, extract, language, ledger, stats, url_filter, url_records
from linkmill.operators import documents as D
from linkmill.operators import submissions as P
from linkmill.operators.lsh_index import ClusteredIndex
from linkmill.plans import corpus
from linkmill.plans.derived import (
    documents,
    order_submissions,
    pages,
    post_lines,
    posts,
    scored_documents,
    submissions,
    table,
    url_variants,
)
from linkmill.schemas import META_FIELDS
from linkmill.session import scratch_path, written
from linkmill.sources import documents as doc_files
from linkmill.sources import dumps, files, packed, releases, url_files
from linkmill.sources import submissions as sub_files
from linkmill.sources.url_store import UrlStore
from linkmill.sources.zstd import write_zst_lines
from linkmill.streaming import dedup as dedup_stream
from linkmill.streaming import extraction, ingest

Query = Callable[[SparkSession, str], DataFrame]

#: Thresholds that split the test data, where the default lets everything pass.
HIGH_SCORE = 1500
URLS_PER_BATCH = 40
N_BATCHES = 7


def _flat_submissions(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "url", "score", "title", "subreddit", S.iso_timestamp(F.col("created_utc")).alias("created_utc")
    )


def _flat_records(records: DataFrame) -> DataFrame:
    """Arrays as text, so that any engine compares them alike."""
    text = {
        f: F.array_join(F.col(f"meta.{f}").cast("array<string>"), "|")
        for f in META_FIELDS
        if f not in ("created_utc",)
    }
    times = F.array_join(F.transform("meta.created_utc", S.iso_timestamp), "|")
    return records.select(
        "url", "part", "total_score", *[c.alias(f"{f}s") for f, c in text.items()], times.alias("times")
    )


# --- dumps and submissions -----------------------------------------------------------------------------------


def read_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """Dumps written in two codecs, read back and turned into submissions."""
    path = scratch_path(spark, "dumps")
    lines = post_lines(posts(spark, sf))
    lines.where("kind = 'click'").select("value").write.text(f"{path}/bz2", compression="bzip2")
    write_zst_lines(lines.where("kind <> 'click'").select("value"), f"{path}/zst", mode="append")
    return _flat_submissions(P.to_submissions(dumps.read_dumps(spark, path, "part-*")))


def split_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """Dumps of many zstd frames, whose runs of frames are read by tasks of their own."""
    path = scratch_path(spark, "split-dumps")
    write_zst_lines(post_lines(posts(spark, sf)).select("value"), path, frame_bytes=20_000)
    found = files.find_files(spark, path)
    rows = packed.read_split(found, found.count(), run_bytes=10_000).select("value")
    return _flat_submissions(P.to_submissions(dumps.parse_posts(rows)))


def link_posts(spark: SparkSession, sf: str) -> DataFrame:
    return P.link_posts(posts(spark, sf)).select("id", "url", "score")


def score_default(spark: SparkSession, sf: str) -> DataFrame:
    """Posts without a score count as 0."""
    unscored = posts(spark, sf).withColumn("score", F.nullif("score", F.lit(5)))
    rows = dumps.parse_posts(post_lines(unscored))
    return P.to_submissions(rows).select("id", "score")


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged lines by reason: cut-off JSON, ids and times that cannot be read."""
    lines = post_lines(posts(spark, sf).withColumn("is_self", F.lit(False)))
    value = F.col("value")
    damaged = (
        F.when(F.col("kind") == "error", F.left(value, F.length(value) - 5))
        .when(F.col("kind") == "signup", F.replace(value, F.lit('"id":"'), F.lit('"id":"t3_')))
        .when(F.col("kind") == "view", F.replace(value, F.lit('"created_utc":"'), F.lit('"created_utc":"x')))
        .otherwise(value)
    )
    bad = P.quarantine(dumps.parse_posts(lines.withColumn("value", damaged)))
    return bad.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def dedup_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Two events per id; the smaller submission survives."""
    doubled = submissions(spark, sf).withColumn("id", F.expr("id div 2"))
    return _flat_submissions(P.dedup_by_id(doubled))


def base36_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "events").select("event_id", S.long_to_base36(F.col("event_id") * 1000003).alias("id36"))
    return ids.withColumn("decoded", S.base36_to_long(F.col("id36")))


def epoch_times(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch seconds as whole and as fractional numbers in text."""
    epoch = table(spark, sf, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("epoch")
    )
    return epoch.select(
        "event_id",
        S.iso_timestamp(S.epoch_to_ntz(F.col("epoch"))).alias("whole"),
        S.iso_timestamp(S.epoch_to_ntz(F.concat("epoch", F.lit(".75")))).alias("fraction"),
    )


def period_columns(spark: SparkSession, sf: str) -> DataFrame:
    month = F.date_format("o_orderdate", "M,yyyy")
    return (
        table(spark, sf, "orders")
        .select(S.month_column(month).alias("month"))
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("month", "yyyy-MM-dd").alias("month"), "n")
    )


def scan_submissions_period(spark: SparkSession, sf: str) -> DataFrame:
    """A table in month folders, scanned for two years of it."""
    path = scratch_path(spark, "submissions")
    sub_files.write_submissions(order_submissions(spark, sf), path)
    start, end = S.parse_month("6,1996"), S.parse_month("5,1998")
    return _flat_submissions(sub_files.scan_submissions(spark, path, start, end))


def scan_submissions_open_start(spark: SparkSession, sf: str) -> DataFrame:
    """Only an end is given, so the start is the first known month."""
    shifted = order_submissions(spark, sf).withColumn("created_utc", F.expr("created_utc + interval 10 years"))
    return _flat_submissions(P.in_period(shifted, None, S.parse_month("3,2007")))


def submissions_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tsv")
    sub_files.write_submissions_tsv(submissions(spark, sf), path)
    return _flat_submissions(sub_files.read_submissions_tsv(spark, path))


def ordered_by_url(spark: SparkSession, sf: str) -> DataFrame:
    return submissions(spark, sf).select("url", "id", "score").orderBy("url", "id")


def dump_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Available files made up of the months and formats that have many orders."""
    formats = F.create_map(
        *[F.lit(x) for x in ("1-URGENT", "zst", "2-HIGH", "xz", "3-MEDIUM", "bz2", "4-NOT SPECIFIED", "xz", "5-LOW", "old")]
    )
    by_month = (
        table(spark, sf, "orders")
        .select(
            F.expr("date_trunc('month', o_orderdate) + interval 12 years").alias("month"),
            formats[F.col("o_orderpriority")].alias("format"),
        )
        .groupBy("month", "format")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    mean = by_month.agg(F.avg("n")).scalar()
    stem = F.date_format("month", "yyyy-MM")
    name = F.when(F.col("format") == "old", F.concat(F.lit("RS_v2_"), stem, F.lit(".xz"))).otherwise(
        F.concat(F.lit("RS_"), stem, F.lit("."), F.col("format"))
    )
    available = by_month.where(F.col("n") > mean).select(name.alias("file_name"))
    found = dumps.dump_inventory(spark, available, datetime.date(2007, 1, 1), datetime.date(2013, 12, 1))
    return found.select(F.date_format("month", "yyyy-MM").alias("month"), "file_name")


def verify_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """One 'file' per document; labelled documents are on the manifest, with a wrong sum where quality is 0."""
    docs = documents(spark, sf)
    actual = docs.select(F.col("doc_id").cast("string").alias("file_name"), F.sha2("text", 256).alias("actual"))
    shown = F.when(F.col("quality") == 1, F.sha2("text", 256)).otherwise(F.sha2("lang", 256))
    lines = docs.join(table(spark, sf, "labels"), "doc_id").select(
        F.concat(shown, F.lit("  "), F.col("doc_id").cast("string")).alias("value")
    )
    return dumps.verify_files(actual, dumps.parse_manifest(lines))


def _file_a_source(spark: SparkSession, sf: str, label: str, line: Column) -> str:
    """A folder with one text file a source, whose lines are in the order of the documents' ids."""
    path = scratch_path(spark, label)
    docs = documents(spark, sf).repartition("source").sortWithinPartitions("source", "doc_id")
    docs.select(line.alias("value"), "source").write.partitionBy("source").text(path)
    return path


def _source_of(file: str) -> Column:
    return F.regexp_extract(file, "source=([^/]*)/", 1).alias("source")


def file_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """The sum of each of several files, a line for each document of a source."""
    path = _file_a_source(spark, sf, "hashed", F.concat_ws(" ", "doc_id", F.md5("text")))
    return dumps.hash_files(files.find_files(spark, path, "part-*")).select(_source_of("path"), "actual")


# --- URL records ---------------------------------------------------------------------------------------------


def url_record_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """One row per URL with total score >= 3 and the aligned metadata of all its submissions."""
    return _flat_records(url_records.build_url_records(submissions(spark, sf)))


def url_records_high_score(spark: SparkSession, sf: str) -> DataFrame:
    records = url_records.build_url_records(submissions(spark, sf), HIGH_SCORE)
    return records.select("url", "total_score", F.size("meta.id").cast("bigint").alias("n"))


def url_records_split(spark: SparkSession, sf: str) -> DataFrame:
    """Long URLs spread over several rows, put together again: nothing may be lost."""
    records = url_records.build_url_records(submissions(spark, sf), max_meta_per_row=16)
    return records.groupBy("url").agg(
        F.max("total_score").alias("total_score"),
        F.sum(F.size("meta.id")).alias("n"),
        F.sum(url_records.meta_total(F.col("meta.score"))).alias("score_sum"),
        F.sum(url_records.meta_total(F.col("meta.id"))).alias("id_sum"),
    )


def url_totals(spark: SparkSession, sf: str) -> DataFrame:
    return url_records.url_totals(submissions(spark, sf), HIGH_SCORE)


def url_records_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Two periods made separately and merged."""
    subs = submissions(spark, sf)
    cut = F.col("created_utc") < F.lit(datetime.datetime(2024, 1, 15)).cast("timestamp_ntz")
    runs = [url_records.build_url_records(subs.where(c), min_score=None) for c in (cut, ~cut)]
    return _flat_records(url_records.merge_url_records(*runs, min_score=HIGH_SCORE))


def url_store(spark: SparkSession, sf: str) -> DataFrame:
    """Years merged one after another into a store of URL records, copy on write; the last one is merged twice."""
    subs = order_submissions(spark, sf)
    store = UrlStore(scratch_path(spark, "url-store"), buckets=8)
    for version, years in enumerate(((1992, 1993), (1994, 1994), (1995, 2100), (1995, 2100))):
        run = subs.where(F.year("created_utc").between(*years))
        store.merge(url_records.build_url_records(run, min_score=None), min(version, 2))
    return _flat_records(store.read(spark))


def url_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive batches of 40 URLs in url order."""
    records = url_records.build_url_records(submissions(spark, sf))
    return url_files.number_url_batches(records, URLS_PER_BATCH).select("url", "url_batch")


def url_batches_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-size batches after leaving out the first 25 URLs."""
    urls = url_records.url_totals(submissions(spark, sf)).select("url")
    return batching.fixed_batches(urls, ["url"], URLS_PER_BATCH, skip=25)


def url_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of 40 URLs each, read back with their names."""
    path = scratch_path(spark, "urls")
    url_files.write_url_batches(url_records.build_url_records(submissions(spark, sf)), path, URLS_PER_BATCH)
    back = url_files.read_url_files(spark, path)
    return back.select(
        "url",
        S.replace_in_name(S.base_name(F.col("source_file")), "urls", "scrapes").alias("output_name"),
        F.size("meta.id").cast("bigint").alias("n"),
        url_records.meta_total(F.col("meta.score")).alias("total_score"),
        S.iso_timestamp(F.array_max("meta.created_utc")).alias("last_created"),
    )


def url_counts(spark: SparkSession, sf: str) -> DataFrame:
    records = url_records.build_url_records(submissions(spark, sf))
    return stats.url_counts(url_files.number_url_batches(records, URLS_PER_BATCH))


def stored_count(spark: SparkSession, sf: str) -> DataFrame:
    """Counted and stored once; the second call, for a table that has changed since, reads the stored number."""
    path = scratch_path(spark, "url-count")
    urls = url_records.url_totals(submissions(spark, sf))
    first = url_files.stored_count(spark, urls, path)
    again = url_files.stored_count(spark, urls.where(F.col("total_score") >= HIGH_SCORE), path)
    return first.select(F.col("n").alias("n_urls"), again.scalar().alias("n_stored"))


# --- URL checks ----------------------------------------------------------------------------------------------


def url_checks(spark: SparkSession, sf: str) -> DataFrame:
    h = U.host(F.col("url"))
    return url_filter.with_exclude_reason(url_variants(spark, sf)).select(
        "page_id",
        "url",
        "exclude_reason",
        h.alias("host"),
        U.base_domain(h).alias("domain"),
        U.public_suffix(h).alias("suffix"),
        U.is_valid(F.col("url")).alias("is_valid"),
        U.is_blocked_extension(F.col("url")).alias("blocked_extension"),
    )


#: Plain, wildcard and exception rules that tell the hosts of the pages apart.
HOST_RULES = ["// rules", "com", "example.com", "*.example.net", "!m.example.net", "!ththth.example.net", "*.theres.example.com", "org"]


def suffix_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Suffix and registrable domain of each page's host by a table of rules."""
    rules = U.SuffixRules.parse(HOST_RULES)
    h = U.host(F.col("url"))
    return pages(spark, sf).select("page_id", U.public_suffix(h, rules).alias("suffix"), U.base_domain(h, rules).alias("domain"))


def url_exclusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    checked = url_filter.with_exclude_reason(url_variants(spark, sf))
    return checked.groupBy(F.coalesce("exclude_reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def busy_domains(spark: SparkSession, sf: str) -> DataFrame:
    """Pages on a domain list that is itself a table: the domains with more pages than average."""
    site = pages(spark, sf).select("page_id", "url")
    sizes = site.groupBy(U.base_domain(U.host(F.col("url"))).alias("domain")).agg(F.count(F.lit(1)).alias("n"))
    busy = sizes.where(F.col("n") > sizes.agg(F.avg("n")).scalar()).select("domain")
    on, off = url_filter.split_by_domains(site, busy)
    return on.withColumn("listed", F.lit(True)).unionByName(off.withColumn("listed", F.lit(False)))


# --- extraction ----------------------------------------------------------------------------------------------


def extract_article(spark: SparkSession, sf: str) -> DataFrame:
    """Title, language, text and word count of every page, or why there is none."""
    found = extract.extract_article(url_variants(spark, sf))
    return found.select(
        "url", "text", "meta.title", "meta.lang", "meta.word_count", "meta.domain", "success", "reason"
    )


def article_titles(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_article(pages(spark, sf))
    return found.select("url", "meta.title", "meta.lang", "meta.scraper", "success")


def extract_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraph text and its word count. Combining marks are taken off again after NFKD for the comparison."""
    found = extract.extract_paragraphs(pages(spark, sf))
    plain = F.regexp_replace("text", r"\p{M}+", "")
    return found.select("url", plain.alias("text"), "meta.word_count")


def simple_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """The same for plain markup, without leaving the JVM."""
    kept = H.long_paragraphs(H.simple_paragraphs(F.col("html")))
    text = S.join_paragraphs(kept, " ")
    return pages(spark, sf).select(
        "page_id",
        text.alias("text"),
        F.size(kept).cast("bigint").alias("n_paragraphs"),
        F.aggregate(F.transform(kept, S.space_words), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_words"),
    )


def nfkd(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", F.regexp_replace(S.nfkd_udf(F.col("text")), r"\p{M}+", "").alias("plain")
    )


def clean_html(spark: SparkSession, sf: str) -> DataFrame:
    return extract.clean_html(url_variants(spark, sf))


def failures_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.extract_paragraphs(url_variants(spark, sf))
    return extract.failures_by_reason(found.select("url", "reason"))


def failures_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Errors and error percentage per batch of 40 pages."""
    variants = url_variants(spark, sf)
    outcomes = extract.extract_paragraphs(variants).groupBy("url").agg(F.min("reason").alias("reason"))
    numbered = batching.fixed_batches(variants.select("page_id", "url"), ["page_id"], URLS_PER_BATCH)
    return extract.failures_by_batch(numbered.join(outcomes, "url"))


def successful_extractions(spark: SparkSession, sf: str) -> DataFrame:
    return D.successful(extract.extract_paragraphs(url_variants(spark, sf))).select("url")


def document_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction results with the renamed metadata of their URL."""
    records = url_records.build_url_records(submissions(spark, sf))
    joined = D.attach_url_meta(D.successful(extract.extract_article(pages(spark, sf))), records)
    as_text = lambda c: F.array_join(F.col(f"meta.{c}").cast("array<string>"), "|").alias(c)
    return joined.select(
        "url",
        "meta.lang",
        "meta.domain",
        as_text("reddit_id"),
        as_text("reddit_score"),
        as_text("subreddit"),
        as_text("reddit_title"),
    )


def _entries(rows: DataFrame, ids: str, scores: str) -> DataFrame:
    """(url, total_score, id, score): one row per entry of the arrays."""
    zipped = F.explode(F.arrays_zip(F.col(ids).alias("id"), F.col(scores).alias("score"))).alias("e")
    return rows.select("url", "total_score", zipped).select("url", "total_score", "e.id", "e.score")


def document_meta_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every entry of every document's metadata, with rows of at most 16 entries or so."""
    records = url_records.build_url_records(submissions(spark, sf), max_meta_per_row=16)
    joined = D.attach_url_meta(D.successful(extract.extract_article(pages(spark, sf))), records)
    return _entries(joined, "meta.reddit_id", "meta.reddit_score")


def url_files_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same entries from URL files that were written and read back."""
    path = scratch_path(spark, "split-urls")
    records = url_records.build_url_records(submissions(spark, sf), max_meta_per_row=16)
    url_files.write_url_batches(records, path, URLS_PER_BATCH)
    return _entries(url_files.read_url_files(spark, path), "meta.id", "meta.score")


# --- documents -----------------------------------------------------------------------------------------------


def document_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as zstd JSON lines and read back with typed metadata."""
    path = scratch_path(spark, "documents")
    docs = documents(spark, sf).select("text", F.struct("doc_id", "lang", "source").alias("meta"))
    doc_files.write_documents(docs, path)
    back = doc_files.read_documents(spark, path, meta_schema=docs.schema["meta"].dataType)
    return back.select(
        "meta.doc_id", "meta.lang", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5")
    )


def document_open_meta(spark: SparkSession, sf: str) -> DataFrame:
    """The same with metadata left as JSON text, some of it missing, through gzip files."""
    path = scratch_path(spark, "open-meta")
    meta = F.when(F.col("lang") != "fr", F.to_json(F.struct("doc_id", "source")))
    doc_files.write_documents(documents(spark, sf).select("text", meta.alias("meta")), path, compression="gzip")
    back = doc_files.read_documents(spark, path, "*.gz")
    return back.select(F.md5("text").alias("text_md5"), "meta")


def document_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Texts stored as lists of paragraphs, joined on reading."""
    lines = documents(spark, sf).select("doc_id", F.to_json(F.struct(F.split("text", " ", -1).alias("text"))).alias("value"))
    joined = doc_files.parse_documents(lines, get_meta=True, para_joiner="\n\n")
    return joined.select("doc_id", F.md5("text").alias("text_md5"), "meta")


def document_lists_kept(spark: SparkSession, sf: str) -> DataFrame:
    lines = documents(spark, sf).select("doc_id", F.to_json(F.struct(F.split("text", " ", -1).alias("text"))).alias("value"))
    kept = doc_files.parse_documents(lines, get_meta=False, autojoin_paragraphs=False)
    return kept.select("doc_id", F.size("text").cast("bigint").alias("n_paragraphs"))


def document_bare_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are just a JSON string."""
    whole = F.to_json(F.struct("text"))
    prefix = len('{"text":')
    bare = F.substring(whole, F.lit(prefix + 1), F.length(whole) - prefix - 1)
    lines = documents(spark, sf).select("doc_id", bare.alias("value"))
    return doc_files.parse_documents(lines, get_meta=False).select("doc_id", F.md5("text").alias("text_md5"))


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", S.word_count(F.col("text")).alias("n_words"), S.space_words(F.col("text")).alias("n_pieces")
    )


def min_total_score(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose scores sum to at least 1500."""
    kept = D.with_text(D.min_total_score(scored_documents(spark, sf), HIGH_SCORE))
    return kept.select("doc_id", "total_score")


def min_total_score_default(spark: SparkSession, sf: str) -> DataFrame:
    return D.with_text(D.min_total_score(scored_documents(spark, sf))).select("doc_id")


def language_filter(spark: SparkSession, sf: str) -> DataFrame:
    return D.in_languages(documents(spark, sf), ["en", "de"], "lang").select("doc_id", "lang")


def detected_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document by its text, from profiles of the documents of half of the sources."""
    docs = documents(spark, sf).select("doc_id", "text", "lang", "source")
    profiles = language.fit(docs.where(_is_first_half()))
    return language.detect(docs, profiles, "doc_id")


def min_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return D.min_tokens(documents(spark, sf)).select("doc_id")


def size_table(spark: SparkSession, sf: str) -> DataFrame:
    """Text size per source in MB, and its share of the whole."""
    docs = documents(spark, sf)
    total = docs.agg(F.sum("n_chars")).scalar()
    return (
        docs.groupBy("source")
        .agg(F.sum("n_chars").alias("chars"))
        .select("source", S.scaled(F.col("chars"), 1e6).alias("mb"), S.percent(F.col("chars"), total).alias("pct"))
    )


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.corpus_stats(documents(spark, sf))


# --- files and batches ---------------------------------------------------------------------------------------


def _document_addresses(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", F.col("source").alias("source_file"))
    return batching.with_document_ordinal(docs, ["doc_id"])


def document_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    return _document_addresses(spark, sf)


def documents_per_file(spark: SparkSession, sf: str) -> DataFrame:
    return batching.documents_per_file(documents(spark, sf), "source")


def file_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the id of its file."""
    docs = documents(spark, sf).select("doc_id", "source")
    counts = batching.documents_per_file(docs, "source")
    return batching.attach_file_id(docs, batching.with_file_id(counts, "source"), "source")


def file_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files in about 7 batches; files are (source, language) here, so their sizes differ."""
    docs = documents(spark, sf).select(F.concat_ws("/", "source", "lang").alias("source"))
    counts = written(batching.with_file_id(batching.documents_per_file(docs, "source"), "source"), "files")
    return batching.pack_files(counts, N_BATCHES).select("file_id", "source", "n_docs", "batch")


def aligned_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs kept by input file under a rewritten name, then read back together."""
    path = scratch_path(spark, "aligned")
    name = F.concat(F.lit("job/urls/urls_"), "source", F.lit(".jsonl.zst"))
    scrapes = S.base_name(S.replace_in_name(name, "urls", "scrapes"))
    docs = documents(spark, sf).select("doc_id", S.append_suffix(scrapes, ".minscored").alias("source_file"))
    files.write_aligned(docs, path)
    back = spark.read.schema("doc_id bigint, source_file string").parquet(path)
    return back.select("doc_id", S.replace_in_name(F.col("source_file"), ".jsonl.zst.minscored", "_final.jsonl.zst").alias("source_file"))


def lines_per_file(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of each of several files."""
    path = _file_a_source(spark, sf, "lines", F.md5("text"))
    return files.lines_per_file(spark, path, "part-*").select(_source_of("path"), "n_lines")


def numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in files of JSON lines, one a source, with the number of their line."""
    rows = files.numbered_lines(spark, _file_a_source(spark, sf, "numbered", F.to_json(F.struct("doc_id", "text"))))
    doc_id = F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id")
    return rows.select(doc_id, _source_of("source_file"), "line")


def bitmap_removal(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus without documents of low quality, dropped by address in a narrow pass over bit maps."""
    addressed = _document_addresses(spark, sf).join(documents(spark, sf).select("doc_id", "text"), "doc_id")
    docs = written(addressed, "addressed")
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id")
    dropped = docs.join(bad, "doc_id", "left_semi").select("source_file", "doc_ord")
    path = scratch_path(spark, "final")
    bitmaps.write_without(docs, dropped, path, maps_at_once=8)
    back = spark.read.schema(docs.schema).parquet(path)
    return back.select("doc_id", "source_file", "doc_ord", F.length("text").cast("bigint").alias("n_chars"))


def total_input_size(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sizes")
    documents(spark, sf).select("text", F.lit("{}").alias("meta")).transform(doc_files.document_lines).write.text(path)
    return files.total_size(spark, path, "part-*").select("total_bytes", "total_mb")


def skip_done_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files left to do when those with a toxic document count as done."""
    docs = documents(spark, sf)
    done = docs.join(table(spark, sf, "labels").where("toxic = 1"), "doc_id").select(F.col("source").alias("path"))
    return ingest.skip_done(docs.select(F.col("source").alias("path")).distinct(), done)


# --- near-duplicates -----------------------------------------------------------------------------------------


def word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    toks = documents(spark, sf).select("doc_id", X.tokens(F.col("text")).alias("t"))
    return toks.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


def shingles(spark: SparkSession, sf: str) -> DataFrame:
    """Number of distinct 5-grams and a digest of the sorted set."""
    sets = X.with_shingles(documents(spark, sf).select("doc_id", "text")).select("doc_id", "shingles")
    return sets.select(
        "doc_id",
        F.size("shingles").cast("bigint").alias("n_shingles"),
        F.md5(F.array_join(F.array_sort("shingles"), "\n")).alias("set_md5"),
    )


def _cores(spark: SparkSession) -> int:
    """The given documents may come in one row group, hence one split; signatures are dealt out over all cores."""
    return spark.sparkContext.defaultParallelism


def minhash(spark: SparkSession, sf: str) -> DataFrame:
    sig = X.with_signature(documents(spark, sf).select("doc_id", "text"), tasks=_cores(spark))
    return sig.select("doc_id", *[F.get("sig", F.lit(k)).alias(f"s{k}") for k in range(X.NUM_PERM)])


def band_keys(spark: SparkSession, sf: str) -> DataFrame:
    banded = X.with_bands(X.with_signature(documents(spark, sf).select("doc_id", "text"), tasks=_cores(spark)))
    return dedup.band_rows(banded, "doc_id").select("doc_id", F.col("band").cast("bigint").alias("band"), "band_key")


def greedy_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that survive the greedy pass in doc_id order."""
    kept, _ = corpus.near_dedup(documents(spark, sf), "doc_id", tasks=_cores(spark))
    return kept


def greedy_dedup_short_kept(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = corpus.near_dedup(documents(spark, sf), "doc_id", short_docs="keep", tasks=_cores(spark))
    return kept


def lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the kept documents it shares a band with."""
    banded = corpus.signatures(documents(spark, sf), "doc_id", _cores(spark))
    kept = written(dedup.greedy_keep(banded, "doc_id"), "kept")
    return dedup.lsh_candidates(banded, dedup.index_rows(banded, kept, "doc_id"), "doc_id")


def _is_first_half() -> F.Column:
    return F.substring("source", 4, 10).cast("int") < 10


def _index_at(path: str, **shape: int) -> ClusteredIndex:
    return ClusteredIndex(path, "doc_id", "bigint", **shape)


def incremental_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the second against the index of the first; the first is run twice, which must change nothing."""
    docs = documents(spark, sf)
    index = _index_at(scratch_path(spark, "index"))
    dropped = scratch_path(spark, "dropped")
    halves = [docs.where(_is_first_half()), docs.where(~_is_first_half())]
    for batch_id, half in ((0, halves[0]), (1, halves[1]), (0, halves[0])):
        dedup_stream.dedup_batch(half, "doc_id", index, dropped, batch_id, _cores(spark))
    lost = spark.read.schema("doc_id bigint, batch_id bigint").parquet(dropped)
    return docs.select("doc_id").join(lost.select("doc_id"), "doc_id", "left_anti")


def compacted_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index after five batches, by source, compacted after every second one."""
    docs = documents(spark, sf)
    index = _index_at(scratch_path(spark, "index"), buckets=4, compact_every=2)
    dropped = scratch_path(spark, "dropped")
    for batch_id in range(5):
        batch = docs.where(F.substring("source", 4, 10).cast("int") % 5 == batch_id)
        dedup_stream.dedup_batch(batch, "doc_id", index, dropped, batch_id, _cores(spark))
    return index.before(spark, 5)


def duplicate_list(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses (file, position) of the dropped documents; the order is (file, position)."""
    docs = documents(spark, sf)
    addressed = batching.with_document_ordinal(
        docs.select("doc_id", F.col("source").alias("source_file")), ["doc_id"]
    ).select("doc_id", F.struct("source_file", "doc_ord").alias("address"))
    banded = written(corpus.signatures(docs, "doc_id", _cores(spark)).join(addressed, "doc_id").select("address", "bands"), "addressed")
    dropped = dedup.duplicates(banded, dedup.greedy_keep(banded, "address"), "address")
    return dropped.select("address.source_file", "address.doc_ord")


def apply_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    _, dropped = corpus.near_dedup(docs, "doc_id", tasks=_cores(spark))
    return dedup.apply_duplicates(docs, dropped, ["doc_id"]).select("doc_id", "source", "lang", "n_chars")


def union_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicates together with exact copies, each once."""
    docs = documents(spark, sf)
    _, near = corpus.near_dedup(docs, "doc_id", tasks=_cores(spark))
    first = docs.groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id"))
    exact = docs.select("doc_id").join(first.select("doc_id"), "doc_id", "left_anti")
    return dedup.union_duplicates(near, exact)


def duplicate_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    _, dropped = corpus.near_dedup(docs, "doc_id", tasks=_cores(spark))
    return stats.duplicate_stats(docs.agg(F.count(F.lit(1)).alias("n_docs")), dropped)


# --- whole flows ---------------------------------------------------------------------------------------------


def clean_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with total score >= 1500 that survive near-dedup, from submissions to the final corpus."""
    result = corpus.clean_corpus(scored_documents(spark, sf), "doc_id", HIGH_SCORE)
    return D.with_text(result.clean).select(
        "doc_id",
        "meta.url",
        "meta.lang",
        "total_score",
        F.length("text").cast("bigint").alias("n_chars"),
    )


def release_table(spark: SparkSession, sf: str) -> DataFrame:
    """Raw and clean release, written, read back and compared."""
    result = corpus.clean_corpus(scored_documents(spark, sf), "doc_id", HIGH_SCORE)
    back = {}
    for name, docs in {"raw": result.raw, "clean": result.clean}.items():
        path = scratch_path(spark, f"release-{name}")
        releases.write_release(docs.select("text", "meta"), path)
        back[name] = spark.read.schema(docs.select("text", "meta").schema).parquet(path)
    return stats.release_table(back)


def release_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """A release in month folders: every order priority and status as a small document."""
    path = scratch_path(spark, "by-month")
    rows = order_submissions(spark, sf).select(
        F.concat_ws(" ", "title", "subreddit", "url").alias("text"),
        F.struct(F.array("created_utc").alias("reddit_created_utc")).alias("meta"),
    )
    releases.write_release(releases.first_submitted(rows), path, month_of="created")
    back = spark.read.schema("text string, month string").parquet(path)
    return back.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text").cast("bigint")).alias("total_chars")
    )


def corpus_from_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """All three stages: dump lines to URL records, pages to documents, documents to the clean corpus."""
    lines = dumps.parse_posts(post_lines(posts(spark, sf)))
    records = written(corpus.url_records_from_posts(lines), "records")
    docs = written(corpus.documents_from_pages(records, pages(spark, sf)), "documents")
    clean = corpus.clean_corpus(docs, "url", HIGH_SCORE).clean
    return clean.select("url", "meta.title", "meta.word_count", F.size("meta.reddit_id").cast("bigint").alias("n_links"))


# --- streams -------------------------------------------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Dump files taken by a stream in two runs; a file seen before is not taken again."""
    base = scratch_path(spark, "stream-ingest")
    lines = post_lines(posts(spark, sf))
    for kinds in ("kind in ('click', 'error')", "kind not in ('click', 'error')"):
        lines.where(kinds).select("value").write.mode("append").text(f"{base}/dumps", compression="bzip2")
        ingest.ingest_dumps(spark, f"{base}/dumps/*.bz2", f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return _flat_submissions(ingest.read_ingested(spark, f"{base}/table"))


def verified_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Dump files checked against a manifest before they are loaded; one kind of post has a wrong sum there."""
    base = scratch_path(spark, "verified-ingest")
    lines = post_lines(posts(spark, sf))
    for kind in ("click", "error", "purchase", "view"):
        lines.where(F.col("kind") == kind).select("value").write.text(f"{base}/dumps/{kind}")
    sums = dumps.file_checksums(spark, f"{base}/dumps", "*.txt")
    wrong = dumps.file_checksums(spark, f"{base}/dumps/purchase", "*.txt").select("file_name", F.lit(True).alias("wrong"))
    expected = F.when(F.col("wrong"), F.lit("0" * 64)).otherwise(F.col("actual")).alias("expected")
    manifest = written(sums.join(wrong, "file_name", "left").select("file_name", expected), "manifest")
    ingest.ingest_dumps(spark, f"{base}/dumps/*/*.txt", f"{base}/table", f"{base}/checkpoint", manifest=manifest).awaitTermination()
    return _flat_submissions(ingest.read_ingested(spark, f"{base}/table"))


def ledger_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics by language of a corpus that grew in three batches, one of them written twice, from the ledger alone."""
    base = scratch_path(spark, "ledger")
    docs = documents(spark, sf).select("doc_id", "text", "lang", "source")
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id")
    for n in (0, 1, 1, 2):
        batch = docs.where(F.substring("source", 4, 10).cast("int") % 3 == n)
        ledger.add_batch(batch, f"{base}/documents", f"{base}/ledger", n, ("lang", "source"), batch.join(bad, "doc_id", "left_semi"))
    return ledger.fold(spark, f"{base}/ledger", ("lang",)).drop("n_errors", "error_pct")


def _extracted_by_stream(spark: SparkSession, sf: str, records: DataFrame | None = None) -> str:
    """Page files taken by a stream in two runs, plain and secure URLs; the folder of its results."""
    base = scratch_path(spark, "stream-extraction")
    variants = url_variants(spark, sf)
    secure = F.col("url").startswith("https://")
    for half in (secure, ~secure):
        variants.where(half).write.mode("append").parquet(f"{base}/pages")
        extraction.extract_pages(
            spark,
            f"{base}/pages",
            f"{base}/documents",
            f"{base}/checkpoint",
            extract.paragraph_extractor,
            files_per_batch=1000,
            records=records,
            outcomes=f"{base}/outcomes",
        ).awaitTermination()
    return base


def stream_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Page files taken by a stream."""
    back = spark.read.parquet(f"{_extracted_by_stream(spark, sf)}/documents")
    return back.select("url", "meta.word_count")


def stream_extraction_meta(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the metadata and total score of each URL, whatever its score, and the ids of all its submissions."""
    records = written(url_records.build_url_records(submissions(spark, sf), min_score=None), "records")
    back = spark.read.parquet(f"{_extracted_by_stream(spark, sf, records)}/documents")
    # The ids of an often submitted URL are spread over several rows of its batch.
    whole = back.groupBy("batch_id", "url").agg(
        F.max("meta.word_count").alias("word_count"),
        F.max("total_score").alias("total_score"),
        F.sort_array(F.flatten(F.collect_list("meta.reddit_id"))).alias("ids"),
    )
    return whole.select("url", "word_count", "total_score", F.array_join(F.col("ids").cast("array<string>"), "|").alias("reddit_id"))


def stream_extraction_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Errors and error percentage of each batch of the stream; the first batch has the secure URLs."""
    outcomes = spark.read.parquet(f"{_extracted_by_stream(spark, sf)}/outcomes")
    first = outcomes.withColumn("secure", F.col("batch_id") == 0)
    return extract.failures_by_batch(first, "secure")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Document files taken by a stream in two runs against one index."""
    base = scratch_path(spark, "stream-dedup")
    docs = documents(spark, sf).select("doc_id", "text", "source")
    for half in (_is_first_half(), ~_is_first_half()):
        docs.where(half).write.mode("append").parquet(f"{base}/documents")
        dedup_stream.dedup_documents(
            spark, f"{base}/documents", docs.schema, "doc_id", f"{base}/index", f"{base}/dropped", f"{base}/checkpoint", tasks=_cores(spark)
        ).awaitTermination()
    lost = spark.read.schema("doc_id bigint, batch_id bigint").parquet(f"{base}/dropped")
    return docs.select("doc_id").join(lost.select("doc_id"), "doc_id", "left_anti")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        read_dumps,
        split_dumps,
        link_posts,
        score_default,
        quarantine,
        dedup_by_id,
        base36_ids,
        epoch_times,
        period_columns,
        scan_submissions_period,
        scan_submissions_open_start,
        submissions_tsv,
        ordered_by_url,
        dump_inventory,
        verify_checksums,
        file_checksums,
        url_record_arrays,
        url_records_high_score,
        url_records_split,
        url_totals,
        url_records_merged,
        url_store,
        url_batches,
        url_batches_skipped,
        url_batch_files,
        url_counts,
        stored_count,
        url_checks,
        suffix_rules,
        url_exclusion_counts,
        busy_domains,
        extract_article,
        article_titles,
        extract_paragraphs,
        simple_paragraphs,
        nfkd,
        clean_html,
        failures_by_reason,
        failures_by_batch,
        successful_extractions,
        document_meta,
        document_meta_split,
        url_files_split,
        document_round_trip,
        document_open_meta,
        document_lists,
        document_lists_kept,
        document_bare_strings,
        word_counts,
        min_total_score,
        min_total_score_default,
        language_filter,
        detected_language,
        min_tokens,
        size_table,
        corpus_stats,
        document_ordinals,
        documents_per_file,
        file_ids,
        file_batches,
        aligned_outputs,
        lines_per_file,
        numbered_lines,
        bitmap_removal,
        total_input_size,
        skip_done_files,
        word_tokens,
        shingles,
        minhash,
        band_keys,
        greedy_dedup,
        greedy_dedup_short_kept,
        lsh_candidates,
        incremental_dedup,
        compacted_index,
        duplicate_list,
        apply_duplicates,
        union_duplicates,
        duplicate_stats,
        clean_corpus,
        release_table,
        release_by_month,
        corpus_from_dumps,
        stream_ingest,
        verified_ingest,
        ledger_stats,
        stream_extraction,
        stream_extraction_meta,
        stream_extraction_failures,
        stream_dedup,
    ]
}
