"""From documents to a training mix: quality, exact copies, near copies, benchmark passages, mixture.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the
columns of ``docs``. An empty table gives an empty one; repeated rows are told apart by their place where it matters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import table
from linkmill.llm.decontaminate import find_contamination
from linkmill.llm.exact_dups import drop_copies, located, rows_at
from linkmill.llm.mixture import mix
from linkmill.llm.near_dups import near_duplicates
from linkmill.llm.quality import resampler
from linkmill.session import written


def _aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Id and text beside one struct of all other columns, whose names then can't clash with an operator's; and the
    way back."""
    own = ("doc_id", "text")
    others = [c for c in docs.columns if c not in own]
    kept = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others")] if others else []

    def back(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c) if c in own else F.col(f"_others.`{c}`").alias(c) for c in docs.columns])

    return docs.select(*own, *kept), back


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling selects, and those without n-grams: null and empty texts and white space,
    of which nothing can be said."""
    rows, back = _aside(docs)
    _, mark = resampler(rows, table(spark, sf_dir, "labels"))
    says_nothing = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return back(mark(rows).where(F.col("selected") | says_nothing))


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for ASCII white space."""
    return drop_copies(docs)


def keep_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row: that with the smallest id (null last), then the first place."""

    def copies(source: DataFrame) -> DataFrame:
        groups = near_duplicates(located(source.select("doc_id", "text")), place=("_file", "_at"))
        # The list grows with the documents, so it is never broadcast.
        return written(groups.where("not kept").select("_file", "_at"), "near-copies").hint("shuffle_hash")

    return rows_at(docs, copies, "left_anti")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with passages of the benchmark."""
    rows, back = _aside(docs)
    found = find_contamination(rows, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return back(found.where(~F.col("contaminated")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and epoch in which it is taken, with the tokens taken."""
    return mix(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", keep_exact),
    ("simhash near-dedup", keep_near),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mixture),
]

#: Hashed n-gram models and SimHash components can't be said in SQL; the test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
