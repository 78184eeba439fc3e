"""Importance resampling towards a target: weights from hashed n-gram models, and the highest scores drawn exactly.

Texts are scored as arrays of bytes; the scores are written, and a binary search of counts over them finds the cutoff,
by score, then among its ties by id. Only the drawn rows are sorted, in ranges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import table
from linkmill.llm.slabs import IS_GAP, LOWER, slabs, text_bytes, word_spans
from linkmill.operators.ordinals import with_ordinal
from linkmill.session import scratch_path, written_with

#: Buckets of features; words a document needs to be drawn, and the percentage drawn; the seed of the noise.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Scores are whole thousandths.
SCALE = 1000

#: Words up to this many bytes are hashed side by side, the few longer ones one by one.
_SIDE_BY_SIDE = 64


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of one more byte, by the low byte of the state; and what a state's four bytes become after n more bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (step >> 1)
    moved = np.empty((_SIDE_BY_SIDE + 1, 4, 256), np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for n in range(_SIDE_BY_SIDE):
        moved[n + 1] = step[moved[n] & 255] ^ (moved[n] >> 8)
    return step, moved


_STEP, _MOVED = _crc_tables()


def _crc_words(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of bytes: byte after byte for all words that are long enough."""
    order = np.argsort(-np.minimum(size, _SIDE_BY_SIDE + 1).astype(np.int8), kind="stable")
    at, length = start[order], size[order]
    first = int(np.count_nonzero(size > _SIDE_BY_SIDE))
    state = np.full(len(at), 0xFFFFFFFF, np.uint32)
    # Of the words in falling length, the first ``ends[j]`` have a byte j.
    ends = len(at) - np.searchsorted(length[::-1][: len(at) - first], np.arange(_SIDE_BY_SIDE), side="right")
    for j, end in enumerate(ends):
        if end <= first:
            break
        now = state[first:end]
        state[first:end] = _STEP[(now ^ data[at[first:end] + j]) & 255] ^ (now >> 8)
    found = np.empty(len(at), np.uint32)
    found[order] = ~state
    for i in order[:first]:
        found[i] = zlib.crc32(data[start[i] : start[i] + size[i]])
    return found


def _crc_pairs(data: np.ndarray, left: np.ndarray, right: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two words with one space between them, from the words' own; ``start`` and ``size`` are the second's."""
    spaced = ~left
    spaced = ~(_STEP[(spaced ^ 32) & 255] ^ (spaced >> 8))
    short = np.minimum(size, _SIDE_BY_SIDE)
    found = right.copy()
    for k in range(4):
        found ^= _MOVED[short, k, (spaced >> (8 * k)) & 255]
    for i in np.flatnonzero(size > _SIDE_BY_SIDE):
        found[i] = zlib.crc32(data[start[i] : start[i] + size[i]], int(spaced[i]))
    return found


class Features(NamedTuple):
    """Buckets of the features of rows ``first`` to ``last``: the row of each, counted from ``first``, and its words."""

    first: int
    last: int
    words: np.ndarray
    row: np.ndarray
    bucket: np.ndarray


def features(column: pa.Array) -> Iterator[Features]:
    """Words and pairs of neighbouring words of each text, A-Z in lower case; a long text comes in several parts."""
    data, offsets = text_bytes(column)
    before = None
    for slab in slabs(data, offsets, IS_GAP):
        part = LOWER[data[slab.start : slab.end]]
        bounds = np.clip(offsets[slab.first : slab.last + 1], slab.start, slab.end) - slab.start
        start, end, row = word_spans(part, bounds)
        size = end - start
        single = _crc_words(part, start, size)
        second = np.flatnonzero(row[1:] == row[:-1]) + 1
        left = single[second - 1]
        if slab.continued and before is not None and len(start):
            left, second = np.concatenate([before, left]), np.concatenate([[0], second])
        paired = _crc_pairs(part, left, single[second], start[second], size[second])
        if len(single):
            before = single[-1:]
        elif not slab.continued:
            before = None
        all_rows, all_crcs = np.concatenate([row, row[second]]), np.concatenate([single, paired])
        yield Features(slab.first, slab.last, np.bincount(row, minlength=slab.last - slab.first), all_rows, (all_crcs % np.uint32(BUCKETS)).astype(np.int64))


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket's features occur in all texts. At most ``BUCKETS`` rows a task are shuffled, and as many
    numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for found in features(batch.column(0)):
                total += np.bincount(found.bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = texts.select(F.col(f"`{text}`")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(BUCKETS, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of a bucket's share in the target and in the raw texts, one added to each count."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    all_s, all_t = float(raw.sum()), float(target.sum())
    return np.floor(SCALE * np.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS)))).astype(np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``n_features`` and ``weight``, the floored mean of the gains."""
    kept = [c for c in docs.columns if c not in (text, "n_words", "n_features", "weight")]
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for found in features(batch.column(last)):
                rows = slice(found.first, found.last)
                words[rows] += found.words
                n[rows] += np.bincount(found.row, minlength=found.last - found.first)
                # Doubles add whole numbers exactly up to 2 ** 53.
                total[rows] += np.bincount(found.row, shared.value[found.bucket], found.last - found.first).astype(np.int64)
            arrays = [batch.column(i) for i in range(last)] + [pa.array(a) for a in (words, n, total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:last], "n_words", "n_features", "weight"])

    sent = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return sent.mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from the seed and the id only; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def smallest_reaching(rows: DataFrame, column: str, k: int, low: int, high: int) -> int:
    """The smallest number c with at least ``k`` rows of ``column`` <= c, which lies from ``low`` to ``high``; each step
    of the binary search counts rows of a written table."""
    while low < high:
        middle = (low + high) // 2
        if rows.where(F.col(column) <= middle).count() >= k:
            high = middle
        else:
            low = middle + 1
    return low


#: The order of drawing; nulls last, and repeated rows by their place in the written scores.
ORDER = ("_below", "_no_id", "doc_id", "_place")


def drawn(scores: DataFrame, k: int) -> Column | None:
    """Which of the written ``scores`` are the first ``k`` in ``ORDER``, by whole numbers found column after column;
    None: none of them."""
    if k <= 0:
        return None
    before, tied = F.lit(False), F.lit(True)
    rows = scores
    for column in ORDER:
        low, high, n, filled = rows.agg(F.min(column), F.max(column), F.count(F.lit(1)), F.count(column)).first()
        if n <= k:
            return before | tied
        if not filled:
            continue  # rows without an id are told apart by their place
        cut = smallest_reaching(rows, column, k, low, high)
        before = before | (tied & (F.col(column) < cut))
        tied = tied & (F.col(column) == cut)
        k -= rows.where(F.col(column) < cut).count()
        rows = rows.where(F.col(column) == cut)
    return before | tied


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank`` (null unless drawn).

    ``docs`` has a whole-numbered ``doc_id`` and ``text``, ``target`` has ``text``. Of the N rows with ``least_words``
    words or more, floor(``percent`` * N / 100) with the highest scores are drawn, ties to the smaller id (null last),
    then in the order of the written scores; rank 1 is the highest. Null and empty texts have no features and weight 0.
    Repeated rows count and are drawn each; an empty table gives no rows; without a target all gains say how much
    rarer than average a bucket is.

    Two narrow passes read the texts, to count buckets and to weigh. Everything after works on the written scores:
    counts for the cutoff, and a sort in ranges of what is drawn.
    """
    raw, wanted = bucket_counts(docs), bucket_counts(target)
    weighed = with_weights(docs.select("doc_id", "text"), gains(raw, wanted))
    enough = F.col("n_words") >= least_words
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    rows = weighed.select(
        "*",
        score.alias("score"),
        F.when(enough, -score).alias("_below"),
        F.when(F.col("doc_id").isNull(), 1).otherwise(0).alias("_no_id"),
        F.monotonically_increasing_id().alias("_place"),
    )
    scores, n = written_with(rows, scratch_path(docs.sparkSession, "scores"), F.count("_below"))
    may = scores.where("_below is not null")
    chosen = drawn(may, percent * n // 100)
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if chosen is None:
        return scores.select(*out, none)
    ranked = with_ordinal(may.where(chosen), list(ORDER), "_rank")
    rest = scores.where(~F.coalesce(F.col("_below").isNotNull() & chosen, F.lit(False)))
    return ranked.select(*out, (F.col("_rank") + 1).alias("rank")).unionByName(rest.select(*out, none))


def op13_target_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


#: CRC-32 byte by byte, and one global order.
ORACLE = r"""
with recursive
crc(i, c, n) as (select i, i, 0 from range(256) t(i) union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n + 1 from crc where n < 8),
step as (select list(c order by i) s from crc where n = 8),
words as (select 'd' kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w, row_number() over () r from documents
  union all select 'b', null, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), null from benchmark),
feats as (select kind, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) f from words),
hexes as (select f, hex(encode(f)) h from (select distinct f from feats)),
hashed as (select f, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
    lambda c, b: xor(c >> 8, s[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 bucket from hexes, step),
counted as (select bucket, count(*) filter (kind = 'd') s, count(*) filter (kind = 'b') t from feats join hashed using (f) group by bucket),
sums as (select sum(s) ss, sum(t) tt from counted),
gains as (select bucket, floor(1000 * ln((t + 1)::double * (ss + 10000)::double / ((s + 1)::double * (tt + 10000)::double)))::bigint g from counted, sums),
means as (select r, sum(g) g from feats join hashed using (f) join gains using (bucket) where kind = 'd' group by r),
scored as (select doc_id, r, len(w) n_words, greatest(2 * len(w) - 1, 0)::bigint n_features, coalesce(floor(g::double / (2 * len(w) - 1)), 0)::bigint weight,
    ('0x' || left(sha256('7:' || coalesce(doc_id::varchar, '')), 8))::bigint h from words left join means using (r) where kind = 'd'),
final as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint score from scored),
ranked as (select r, row_number() over (order by score desc, doc_id) k from final where n_words >= 20)
select doc_id::bigint doc_id, n_features, weight, score, case when k <= 25 * (select count(*) from ranked) // 100 then k end rank from final left join ranked using (r)
"""
