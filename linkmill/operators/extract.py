"""Text extraction from fetched pages."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions.html import article, clean_markup, paragraph_text
from linkmill.functions.scalars import has_text, percent
from linkmill.functions.urls import base_domain, exclude_reason, host

#: What an extractor yields for each (url, html).
EXTRACTED = (
    "url string, text string, title string, lang string, word_count bigint, elapsed double, scraper string,"
    " success boolean, error string"
)

_EXTRACTED_NAMES = [column.split(" ")[0] for column in EXTRACTED.split(", ")]

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

#: An extractor gets at most so many pages at a time, and so many characters of html unless a page alone has more,
#: however large the batches are in which Spark hands pages over.
PART_ROWS, PART_CHARS = 500, 1 << 20


def per_page(scraper: str, read: Callable[[str], dict]) -> Extractor:
    """An extractor from a function of one page; a page that fails is a row without success, never an error."""

    def extractor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, html in zip(batch["url"], batch["html"]):
                row = {"url": url, "scraper": scraper, "success": False}
                started = time.perf_counter()
                try:
                    row.update(read(html), success=True)
                except Exception as problem:  # noqa: BLE001
                    row["error"] = f"{type(problem).__name__}: {problem}"
                row["elapsed"] = time.perf_counter() - started
                rows.append(row)
            columns = [field.split()[0] for field in EXTRACTED.split(", ")]
            frame = pd.DataFrame(rows, columns=columns, dtype=object)
            yield frame.astype({"elapsed": float, "success": bool})

    return extractor


def _article_row(html: str) -> dict:
    title, lang, text = article(html)
    return {"title": title, "lang": lang, "text": text, "word_count": len(text.split())}


def _paragraph_row(html: str) -> dict:
    text, words, _ = paragraph_text(html)
    return {"text": text, "word_count": words}


# The scraper names in the metadata.
article_extractor: Extractor = per_page("newspaper", _article_row)
paragraph_extractor: Extractor = per_page("bs4", _paragraph_row)


def _bounded(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of bounded size."""
    first = size = 0
    for at, html in enumerate(batch["html"]):
        length = len(html) if isinstance(html, str) else 0
        if at > first and (at - first == PART_ROWS or size + length > PART_CHARS):
            yield batch.iloc[first:at]
            first, size = at, 0
        size += length
    yield batch.iloc[first:]


def _one_pass(extractor: Extractor) -> Extractor:
    """The extractor for pages without a ``reason``; the others pass by with theirs. What becomes of a part is handed on
    before the next one is read."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def usable() -> Iterator[pd.DataFrame]:
            for part in (bounded for batch in parts for bounded in _bounded(batch)):
                out = part["reason"].notna()
                rows = [{"url": u, "reason": r, "success": False} for u, r in zip(part["url"][out], part["reason"][out])]
                passed = pd.DataFrame(rows, columns=[*_EXTRACTED_NAMES, "reason"], dtype=object)
                waiting.append(passed.astype({"elapsed": float, "success": bool}))
                yield part.loc[~out, ["url", "html"]]

        for done in extractor(usable()):
            yield done.assign(reason=pd.Series([None] * len(done), index=done.index, dtype=object))
            while waiting:
                yield waiting.pop()
        while waiting:
            yield waiting.pop()

    return run


def extract(pages: DataFrame, extractor: Extractor = article_extractor) -> DataFrame:
    """(url, text, meta, success, reason, error) for pages (url, html), in one pass over them.

    Excluded URLs are settled first; their html is not sent to Python. ``reason`` is the exclusion, ``error`` for a
    page the extractor failed on, whose message is in the column ``error``, ``empty_text``, or null. Python gets pages
    in batches of the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``, the extractor gets these in parts of
    at most ``PART_CHARS``.
    """
    reason = exclude_reason(F.col("url"))
    settled = pages.select("url", "html", reason.alias("reason"))
    sent = settled.select("url", F.when(F.col("reason").isNull(), F.col("html")).alias("html"), "reason")
    done = sent.mapInPandas(_one_pass(extractor), f"{EXTRACTED}, reason string")
    is_empty = ~has_text(F.col("text"))
    why = F.coalesce("reason", F.when(~F.col("success"), "error").when(is_empty, "empty_text"))
    rows = done.withColumn("reason", why)
    meta = F.struct(
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("lang"),
        F.col("url"),
        F.col("word_count"),
        F.col("elapsed"),
        F.col("scraper"),
        base_domain(host(F.col("url"))).alias("domain"),
    )
    return rows.select("url", "text", meta.alias("meta"), "success", "reason", "error")


def extract_article(pages: DataFrame) -> DataFrame:
    return extract(pages, article_extractor)


def extract_paragraphs(pages: DataFrame) -> DataFrame:
    return extract(pages, paragraph_extractor)


def clean_html(pages: DataFrame) -> DataFrame:
    """(url, html, success): minified markup without scripts and styles; nothing leaves the JVM."""
    excluded = exclude_reason(F.col("url")).isNotNull()
    cleaned = F.when(~excluded, clean_markup(F.col("html")))
    return pages.select("url", cleaned.alias("html")).withColumn("success", F.col("html").isNotNull())


def failures_by_reason(extracted: DataFrame) -> DataFrame:
    """(reason, n, pct): how many pages ended how; ``ok`` for documents."""
    counts = extracted.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    # A handful of rows by now, so the window without a partition is harmless and the pages are read once.
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


def failures_by_batch(extracted: DataFrame, batch: str = "url_batch") -> DataFrame:
    """(batch, n_urls, n_errors, error_pct): what is recorded when a batch is done."""
    failed = F.col("reason").isNotNull()
    return (
        extracted.groupBy(batch)
        .agg(F.count(F.lit(1)).alias("n_urls"), F.count_if(failed).alias("n_errors"))
        .withColumn("error_pct", percent(F.col("n_errors"), F.col("n_urls")))
    )
