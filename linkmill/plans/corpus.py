"""The three stages end to end: dumps to URL records, pages to documents, documents to the clean corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions.text import PRIME, band_shape, with_bands, with_signature
from linkmill.operators.dedup import apply_duplicates, duplicates, greedy_keep
from linkmill.operators.documents import attach_url_meta, min_total_score, one_per_url, successful, with_text
from linkmill.operators.extract import Extractor, article_extractor, extract
from linkmill.operators.submissions import dedup_by_id, to_submissions
from linkmill.operators.url_filter import usable_urls
from linkmill.operators.url_records import MIN_SCORE, build_url_records
from linkmill.session import written


@dataclass
class Corpus:
    """All results of a clean-up; ``dropped`` holds the keys of the near-duplicates."""

    raw: DataFrame
    filtered: DataFrame
    dropped: DataFrame
    clean: DataFrame


def url_records_from_posts(posts: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    return build_url_records(dedup_by_id(to_submissions(posts)), min_score)


def documents_from_pages(
    records: DataFrame, pages: DataFrame, extractor: Extractor = article_extractor
) -> DataFrame:
    """(url, part, text, meta, total_score, first_created) for the pages fetched for ``records``, written once.

    Extraction comes first and is narrow: only extracted text, not HTML, is shuffled, to keep one page per URL and to
    meet the URL's metadata. The result is a table, so that what follows reads it and extracts nothing again.
    """
    found = one_per_url(successful(extract(pages, extractor)))
    return written(attach_url_meta(found, usable_urls(records)), "documents")


def signatures(docs: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """(key, bands), written once: every dedup step reads these few bytes per document, not the texts. ``tasks`` as in
    ``with_signature``."""
    return written(with_bands(with_signature(docs.select(key, "text"), tasks=tasks)).select(key, "bands"), "bands")


def near_dedup(
    docs: DataFrame, key: str, short_docs: str = "collapse", tasks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept keys, dropped keys). Documents too short for one n-gram all have the same signature: with
    ``collapse`` only the first of them survives, with ``keep`` they take no part and all survive."""
    every = banded = signatures(docs, key, tasks)
    if short_docs == "keep":
        empty = "-".join([str(PRIME)] * band_shape()[1])
        banded = banded.where(~F.forall("bands", lambda b: b == empty))
    elif short_docs != "collapse":
        raise ValueError(short_docs)
    kept = greedy_keep(banded, key)
    dropped = written(duplicates(banded, kept, key), "dropped")
    return every.select(key).join(dropped, key, "left_anti") if short_docs == "keep" else kept, dropped


def clean_corpus(docs: DataFrame, key: str, min_score: int = MIN_SCORE, tasks: int | None = None) -> Corpus:
    """Score filter, near-dedup, and the final corpus for (key, text, meta) documents.

    ``docs`` should be a table, such as ``documents_from_pages`` gives: each result reads it again. Keys are unique
    among rows with text; further parts of a URL go or stay with it.
    """
    filtered = min_total_score(docs, min_score)
    _, dropped = near_dedup(with_text(filtered), key, tasks=tasks)
    return Corpus(docs, filtered, dropped, apply_duplicates(filtered, dropped, [key]))
