"""How filters of a corpus act together: what each removes, alone, after others and on average over all orders.

Texts are read once, as bytes, by a finite-state transducer given by tables; it counts words, capitals, code points and
symbols, and puts the spans of words into a hash table whose hits are verified byte by byte. Which filters a document
fails is then one small number, and every order of the filters is worked out from counts of these numbers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import table
from linkmill.llm.hashing import mixed, powers
from linkmill.llm.slabs import slabs, text_bytes
from linkmill.session import written

#: Kinds of bytes: white space, A-Z, symbols, other first bytes of a character, and bytes that continue one.
_SPACE, _CAPITAL, _SYMBOL, _OTHER, _TAIL = range(5)
KIND = np.full(256, _OTHER, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
KIND[65:91] = _CAPITAL
KIND[[ord(c) for c in "#$%&*|"]] = _SYMBOL
KIND[128:192] = _TAIL

#: The transducer is outside a word or in one. By state and kind of byte: the next state, and what is put out.
OUTSIDE, INSIDE = 0, 1
NEXT = np.array([[OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
_BEGINS, _ENDS, _HAS_CAPITAL, _HAS_SYMBOL, _CONTINUES = 1, 2, 4, 8, 16
PUT_OUT = np.array(
    [
        [0, _BEGINS | _HAS_CAPITAL, _BEGINS | _HAS_SYMBOL, _BEGINS, _BEGINS | _CONTINUES],
        [_ENDS, _HAS_CAPITAL, _HAS_SYMBOL, 0, _CONTINUES],
    ],
    np.uint8,
)
_AFTER, _OUT = NEXT[OUTSIDE], PUT_OUT.ravel()


class SpanTable:
    """An open hash table of word spans over some bytes; a word is known only if its bytes are those of a known one."""

    def __init__(self, data: np.ndarray, expected: int):
        self.data, self.size = data, 0
        self.start, self.end, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.key = np.zeros(0, np.uint64)
        self._slots(max(64, 2 * expected))

    def _slots(self, least: int) -> None:
        self.slot = np.full(1 << int(least - 1).bit_length(), -1, np.int64)
        self.mask = np.uint64(len(self.slot) - 1)
        left, place = np.arange(self.size), (self.key & self.mask).astype(np.int64)
        while len(left):  # known words differ, so each only looks for an empty slot
            free = self.slot[place] < 0
            self.slot[place[free]] = left[free]
            placed = self.slot[place] == left
            left, place = left[~placed], (place[~placed] + 1) & int(self.mask)

    def _same(self, known: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Whether the spans are those words: same key, row and length, then every byte."""
        size = end - start
        same = (self.key[known] == key) & (self.row[known] == row) & (self.end[known] - self.start[known] == size)
        likely = np.flatnonzero(same)
        size = size[likely]
        ends = np.cumsum(size)
        pair = np.repeat(np.arange(len(likely)), size)
        place = np.arange(len(pair)) - (ends - size)[pair]
        differs = self.data[self.start[known[likely]][pair] + place] != self.data[start[likely][pair] + place]
        same[likely[pair[differs]]] = False
        return same

    def insert(self, start: np.ndarray, end: np.ndarray, key: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Put the spans in; the rows of those that weren't known, one for each new word."""
        if 2 * (self.size + len(start)) > len(self.slot):
            self._slots(4 * (self.size + len(start)))
        before = self.size
        left, place = np.arange(len(start)), (key & self.mask).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slot[place] < 0)
            if len(free):
                # Of several spans that want one slot, one gets it; the others then meet it there.
                self.slot[place[free]] = left[free] + (1 << 40)
                taken = free[self.slot[place[free]] == left[free] + (1 << 40)]
                new = left[taken]
                self.slot[place[taken]] = np.arange(self.size, self.size + len(new))
                self.start, self.end = np.concatenate([self.start, start[new]]), np.concatenate([self.end, end[new]])
                self.key, self.row = np.concatenate([self.key, key[new]]), np.concatenate([self.row, row[new]])
                self.size += len(new)
            known = self._same(self.slot[place], start[left], end[left], key[left], row[left])
            left, place = left[~known], (place[~known] + 1) & int(self.mask)
        return self.row[before:]


def _spans(data: np.ndarray, offsets: np.ndarray, put_out: np.ndarray, kinds: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word; ``offsets`` bound the rows, whose ends end a word too."""
    ends = np.zeros(len(data) + 1, bool)
    ends[:-1] = (put_out & _ENDS) != 0
    last = offsets[1:][np.diff(offsets) > 0] - start
    ends[last] = kinds[last - 1] != _SPACE
    return np.flatnonzero(put_out & _BEGINS), np.flatnonzero(ends)


def transduce(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``words, distinct, capitals, points, symbols`` of each row, as an array of five columns."""
    counts = np.zeros((len(offsets) - 1, 5), np.int64)
    known = None
    for slab in slabs(data, offsets, KIND == _SPACE):
        part = data[slab.start : slab.end]
        if not len(part):
            continue
        bounds = np.clip(offsets[slab.first : slab.last + 1], slab.start, slab.end)
        kinds = KIND[part]
        # The next state follows from the byte alone, so the states of all places are found at once. Rows begin outside,
        # and so do the parts of a long row, which is cut after white space.
        states = np.empty(len(part), np.uint8)
        states[0], states[1:] = OUTSIDE, _AFTER[kinds[:-1]]
        begins = bounds[:-1] - slab.start
        states[begins[begins < len(part)]] = OUTSIDE
        put_out = _OUT[states * 5 + kinds]

        first, last = _spans(part, bounds, put_out, kinds, slab.start)
        rows = np.searchsorted(bounds, first + slab.start, side="right") - 1
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        key = mixed(mixed((sums[last] - sums[first]) * down[first]) ^ rows.astype(np.uint64))
        if known is None or not slab.continued:
            known = SpanTable(data, len(first))
        new = known.insert(first + slab.start, last + slab.start, key, rows)

        within = counts[slab.first : slab.last]
        within[:, 0] += np.bincount(rows, minlength=len(within))
        within[:, 1] += np.bincount(new, minlength=len(within))
        for column, bit in ((2, _HAS_CAPITAL), (3, _CONTINUES), (4, _HAS_SYMBOL)):
            within[:, column] += np.diff(np.searchsorted(np.flatnonzero(put_out & bit), bounds - slab.start))
    counts[:, 3] = np.diff(offsets) - counts[:, 3]
    return counts


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the transducer's counts in place of the text, and ``text_digest`` (SHA-256); null counts as empty.

    A narrow pass over Arrow's buffers: rows stay as they are, repeated ones too. Spark bounds the bytes of a batch; a
    text is taken in slabs, so memory besides the text grows with its distinct words only. Columns of ``docs`` with
    names of the new ones are replaced.
    """
    own = (*COUNTS, "text_digest")
    kept = [c for c in docs.columns if c != text and c not in own]
    sent = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)).alias("text_digest"),
        F.col(f"`{text}`").alias("_text"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            counts = transduce(*text_bytes(batch.column(last)))
            arrays = [batch.column(i) for i in range(last)] + [pa.array(counts[:, i]) for i in range(5)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:last], *COUNTS])

    schema = sent.drop("_text").schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return sent.mapInArrow(scan, schema)


#: Filters of the registered query, by letter: in SQL over the counts, when a document fails. E is told apart by ``with_failures``.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_points",
    "D": "n_symbols > 0",
}
REPEATED = "E"


def with_failures(counted: DataFrame, filters: dict[str, str] | None = None, doc_id: str = "doc_id") -> DataFrame:
    """``counted`` with ``failed``: a bit for each filter in order of its letter, the last one for repeated texts.

    A text is repeated if a row with a smaller id has the same one. The smallest id of a text combines map-side and is
    met by (text, id), so a text with a third of all rows isn't gathered. A null id is neither smaller nor larger
    than any, so such a row isn't repeated. ``counted`` should be a written table, it is read twice.
    """
    filters = FILTERS if filters is None else filters
    bits = [F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(filters.values())]
    own = F.lit(0)
    for bit in bits:
        own = own + bit
    key = F.col(f"`{doc_id}`")
    firsts = counted.where(key.isNotNull()).groupBy(F.col("text_digest").alias("_digest")).agg(F.min(key).alias("_first"))
    met = counted.join(firsts, (F.col("text_digest") == F.col("_digest")) & (key == F.col("_first")), "left")
    repeated = F.when(key.isNotNull() & F.col("_first").isNull(), F.lit(1 << len(bits))).otherwise(F.lit(0))
    return met.withColumn("failed", own + repeated).drop("_digest", "_first")


def orders(letters: str) -> Column:
    """Every order of the filters, step by step: ``array<struct<filter_order, step, own, before>>``, with the bit of
    the step's filter and those of the filters before it."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "own": bit[c], "before": sum(bit[b] for b in order[:i])}
        for order in permutations(letters)
        for i, c in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,own:int,before:int>>")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", filters: dict[str, str] | None = None) -> DataFrame:
    """A row per part, order of the filters and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    ``docs`` has ``doc_id``, ``text`` and the part's column (null is the empty string); ``filters`` are conditions over
    ``COUNTS``, by a letter each, with a repeated text as the last filter. There are n! orders, so filters should be
    few. ``labels`` has ``doc_id``, ``quality`` and ``toxic``; if an id has several labels, one that says 1 counts. An
    empty table has no parts and gives no rows; null and empty texts have no words; repeated rows count each.

    ``shapley`` is what the step's filter removes, summed over all orders: a document that fails m filters is removed
    by each of them in 1 / m of the orders.
    """
    letters = "".join(filters or FILTERS) + REPEATED
    narrow = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), "text")
    counted = written(with_counts(narrow), "counted")
    failures = with_failures(counted, filters).select("doc_id", "part", "failed")
    known = labels.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("bad")
    )
    numbers = (
        failures.join(known, "doc_id", "left")
        .groupBy("part", "failed")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("bad").alias("bad"))
    )
    # From here on there are at most 2 ** filters rows a part.
    stepped = numbers.select("*", F.inline(orders(letters)))
    fails, earlier = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    every = 1
    for i in range(2, len(letters) + 1):
        every *= i
    share = (F.lit(every) / F.greatest(F.bit_count("failed"), F.lit(1))).cast("long")

    def total(what: Column, where: Column) -> Column:
        return F.sum(F.when(where, what).otherwise(F.lit(0))).cast("long")

    n = F.col("n")
    return stepped.groupBy("part", "filter_order", "step").agg(
        total(n, ~fails & ~earlier).alias("kept"),
        total(n, fails & ~earlier).alias("removed"),
        total(n, fails & earlier).alias("redundant"),
        total(n, F.col("failed") == F.col("own")).alias("unique_fails"),
        total(F.col("good"), fails & ~earlier).alias("good_lost"),
        total(F.col("bad"), fails & ~earlier).alias("toxic_lost"),
        total(n * share, fails).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


#: Every order runs over every document.
ORACLE = r"""
with recursive
words as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
flags as (select doc_id, part, len(w) < 200 a, 100 * len(list_distinct(w)) < 50 * len(w) b,
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) c, regexp_matches(t, '[#$%&*|]') d,
    coalesce(doc_id > min(doc_id) over (partition by t), false) e from words),
known as (select doc_id, bool_or(quality = 1) good, bool_or(toxic = 1) bad from labels group by doc_id),
docs as (select part, [a, b, c, d, e] f, coalesce(good, false) good, coalesce(bad, false) bad from flags left join known using (doc_id)),
counted as (select part, f, count(*) n, count(*) filter (good) good, count(*) filter (bad) bad from docs group by part, f),
perms as (select '' o union all select o || l from perms, (select unnest(['A', 'B', 'C', 'D', 'E']) l) where not contains(o, l) and len(o) < 5),
steps as (select o filter_order, unnest(range(1, 6))::int step from perms where len(o) = 5),
placed as (select part, filter_order, step, n, good, bad, f[ascii(filter_order[step]) - 64] fails,
    list_sum(list_transform(range(1, step), lambda i: f[ascii(filter_order[i]) - 64]::int)) > 0 before,
    list_sum(list_transform(f, lambda x: x::int)) m, filter_order[step] l
  from counted, steps),
result as (select part, filter_order, step, any_value(l) l, coalesce(sum(n) filter (not fails and not coalesce(before, false)), 0)::bigint kept,
    coalesce(sum(n) filter (fails and not coalesce(before, false)), 0)::bigint removed, coalesce(sum(n) filter (fails and before), 0)::bigint redundant,
    coalesce(sum(n) filter (fails and m = 1), 0)::bigint unique_fails, coalesce(sum(good) filter (fails and not coalesce(before, false)), 0)::bigint good_lost,
    coalesce(sum(bad) filter (fails and not coalesce(before, false)), 0)::bigint toxic_lost
  from placed group by part, filter_order, step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, l))::bigint shapley from result
"""
