"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k on their ratio."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import table
from linkmill.llm.hashing import batches, mixed
from linkmill.session import written

#: Buckets of the hashed n-gram models, and what is added to each bucket's count.
BUCKETS, SMOOTHING = 1 << 16, 1.0
#: At most so many labelled rows, chosen by a hash of their id, make the target model and its calibration. They are
#: broadcast as ids; the raw model and the scores are over all documents.
LABELLED = 20_000
SEED = 42
#: Weight of the Gumbel noise beside the log ratio.
TEMPERATURE = 1.0

#: Stands for a token that repeats the one before it, whatever that was.
_SAME = np.uint64(0x5A17E5A17E5A17E5)


def ngrams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, n, buckets, row)`` of the unigrams and bigrams of neighbouring texts; see ``hashing.batches``.

    Tokens are runs of word characters or of other signs. Where one long text comes in several parts, its n-grams run
    on over their borders.
    """
    last_first = last_hash = last_unit = None
    for first, n, tokens, row in batches(texts):
        h = tokens.hashes()
        skip = int(first == last_first and last_hash is not None)
        if skip:
            h, row = np.concatenate([[last_hash], h]), np.concatenate([[0], row])
        near = row[1:] == row[:-1]
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & near
        units = np.where(same, _SAME, h)
        if skip:
            units[0] = last_unit
        pairs = mixed(units[:-1] * np.uint64(0x2545F4914F6CDD1D) + units[1:])[near]
        grams = np.concatenate([units[skip:], pairs]) % np.uint64(BUCKETS)
        yield first, n, grams.astype(np.int64), np.concatenate([row[skip:], row[1:][near]])
        last_first = first
        last_hash, last_unit = (h[-1], units[-1]) if len(h) else (None, None)


def _counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts of a whole partition: a row for each bucket that occurs."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for part in parts:
        chosen = part["target"].to_numpy(bool)
        for first, _, grams, row in ngrams(list(part["text"])):
            raw += np.bincount(grams, minlength=BUCKETS)
            target += np.bincount(grams[chosen[first + row]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    if len(seen):
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})


def labelled_sample(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """At most ``limit`` rows ``(id, good)``, in order of a hash of the id; a document with any label 0 is not good."""
    clean = labels.where("doc_id is not null and quality is not null")
    each = clean.groupBy(F.col("doc_id").alias("id")).agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))
    return each.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(limit)


def log_ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """Log of target over raw probability for each bucket, from all documents and the sample's good ones."""
    good = sample.where("good = 1").select("id", F.lit(True).alias("target"))
    rows = docs.select("id", "text").join(F.broadcast(good), "id", "left")
    counts = (
        rows.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("target", F.lit(False)).alias("target"))
        .mapInPandas(_counted, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # at most BUCKETS rows
    )
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[counts["bucket"]] += counts["raw"]
    target[counts["bucket"]] += counts["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(spark: SparkSession, text: Column, ratios: np.ndarray) -> Column:
    """The log importance weight of a whole text: the sum over its n-grams; 0 for null and for a text without any."""
    shared = spark.sparkContext.broadcast(ratios)

    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table_ = shared.value
        for part in parts:
            total = np.zeros(len(part))
            for first, n, grams, row in ngrams(list(part)):
                total[first : first + n] += np.bincount(row, weights=table_[grams], minlength=n)
            yield pd.Series(total)

    return F.pandas_udf(scored, T.DoubleType())(F.coalesce(text, F.lit("")))


def gumbel(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on the seed and the id only."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(unit))


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th largest value, by counting 1,024 ranges of values again and again; never sorts all rows."""
    values = rows.select(F.col(column).alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None or k <= 0:
        return None
    while low < high:
        place = F.least(F.floor((F.col("v") - low) / ((high - low) / 1024)), F.lit(1023))
        ranges = values.where(F.col("v").between(low, high)).groupBy(place.alias("place"))
        bins = sorted(ranges.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect(), reverse=True)
        for b in bins:
            if k <= b.n:
                low, high = b.low, b.high
                break
            k -= b.n
        else:
            return bins[-1].low  # k is beyond the number of rows: all are taken
    return low


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The score that parts good from bad rows best (balanced accuracy): the middle of its gap, or 0 if that lies in the
    gap below the middle; -inf without bad rows.

    0 is the weight of what is as likely as raw text. A sum over few n-grams lies near it, so a cut further up would
    reject short good texts for their length only.
    """
    if good.all() or not len(good):
        return -np.inf
    if not good.any():
        return np.inf
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    gain = caught - lost
    gain[1:-1][scores[1:] == scores[:-1]] = -1  # equal scores can't be parted
    cut = int(np.argmax(gain))
    if cut in (0, len(scores)):
        return -np.inf if cut == 0 else np.inf
    middle = float((scores[cut - 1] + scores[cut]) / 2)
    return 0.0 if scores[cut - 1] < 0 < middle else middle


def resampler(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    share: float | None = None,
    temperature: float | None = None,
):
    """``(scores, mark)``: the written table ``(id, log_weight, draw)``, and a function that gives any DataFrame of the
    same documents ``log_weight``, ``draw`` and ``selected``.

    Each document's draw is its log importance weight plus Gumbel noise; the k largest draws are selected, which is
    sampling k documents without replacement in proportion to their weights. k is ``share`` of all rows, rounded down;
    without a share it is the number of documents whose weight lies above the cut that parts the labelled good from the
    labelled bad ones, and without bad labels all stay. ``temperature`` scales the noise (``TEMPERATURE`` by default):
    weights are sums over whole texts, so at 1 the order is nearly that of the weights, and more makes it more even.

    Null and empty texts weigh as much as raw text does (log weight 0), repeated rows are drawn alike and draws equal
    to the last selected one are selected too. Without labelled good documents the model knows nothing to prefer, and
    all weights are those of an even target. An empty table gives no rows.
    """
    spark = docs.sparkSession
    heat = TEMPERATURE if temperature is None else temperature
    sample = written(labelled_sample(labels), "labelled")
    plain = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    ratios = log_ratios(plain, sample)

    def drawn(id_: Column, text_: Column) -> list[Column]:
        return [log_weight(spark, text_, ratios).alias("log_weight"), (gumbel(id_, seed) * heat).alias("noise")]

    scores = written(
        plain.select("id", *drawn(F.col("id"), F.col("text"))).select("id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("draw")),
        "draws",
    )
    if share is None:
        # An id counts once, however often it occurs, so at most LABELLED rows reach the driver.
        labelled = scores.join(F.broadcast(sample), "id").groupBy("id", "good").agg(F.min("log_weight").alias("log_weight"))
        known = labelled.select("log_weight", "good").toPandas()
        cut = best_cut(known["log_weight"].to_numpy(), known["good"].to_numpy(bool))
        k = scores.where(F.col("log_weight") > F.lit(float(cut))).count()
    else:
        k = math.floor(share * scores.count())
    least = kth_largest(scores, "draw", k)
    chosen = F.lit(False) if least is None else F.col("draw") >= F.lit(least)

    def mark(df: DataFrame) -> DataFrame:
        own = ("log_weight", "draw", "noise", "selected")
        kept = [F.col(f"`{c}`") for c in df.columns if c not in own]
        scored = df.select(*kept, *drawn(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
        return scored.withColumn("draw", F.col("log_weight") + F.col("noise")).drop("noise").withColumn("selected", chosen)

    return scores.withColumn("selected", chosen), mark


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores, _ = resampler(docs, table(spark, sf_dir, "labels"))
    return scores.withColumnRenamed("id", "doc_id")
