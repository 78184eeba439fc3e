"""Benchmark decontamination by winnowing: minimum k-gram hashes of sliding windows are joined, and hits extended.

Two texts that share a span of ``WINDOW`` words share ``WINDOW - GRAM + 1`` neighbouring k-grams, hence the smallest
hash among them, and both keep it. So a join of the kept hashes meets every shared span of that length; a hit is then
extended to the windows that hold it, and these are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.llm.common import lower_ascii, once, sieved, table
from linkmill.session import scratch_path, written, written_with

#: Words of a contaminating window, and words of a hashed k-gram; the hash window has WINDOW - GRAM + 1 = 8 k-grams.
WINDOW, GRAM = 13, 6
#: A document is contaminated if one word in so many is hit.
SHARE = 20

#: What stands between words, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased; null has none."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), SEPARATORS), ""), F.array().cast("array<string>"))


def _paired(a: Column, b: Column, shift: int, size: Column, merge) -> Column:
    """``merge(a[i], b[i + shift])`` for the first ``size`` places."""
    size = F.greatest(size, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(shift + 1), size), merge)


def _sliding(values: Column, merge, then) -> Column:
    """``then`` of ``merge`` over every 8 neighbours, by doubling."""
    return once(
        _paired(values, values, 1, F.size(values) - 1, merge),
        lambda two: once(
            _paired(two, two, 2, F.size(two) - 2, merge),
            lambda four: then(_paired(four, four, 4, F.size(four) - 4, merge)),
        ),
    )


def kept_hashes(word_hashes: Column) -> Column:
    """The hash of the 6-gram at each place if it is the smallest of some window of 8 neighbours, else null.

    Equal smallest hashes are all kept. Fewer than 13 words give an empty array.
    """
    mix = lambda x, y: F.xxhash64(x, y)
    edge = F.array_repeat(F.lit(-(1 << 63)).cast("long"), 7)
    grams = lambda one: once(
        _paired(one, one, 1, F.size(one) - 1, mix),
        lambda two: once(
            _paired(two, two, 2, F.size(two) - 2, mix),
            lambda four: _paired(four, two, 4, F.size(four) - 2, mix),
        ),
    )
    kept = lambda six: _sliding(
        six,
        lambda x, y: F.least(x, y),
        # A k-gram is the smallest of one of its windows if the largest of its windows' minima is its own hash.
        lambda low: _sliding(
            F.concat(edge, low, edge), lambda x, y: F.greatest(x, y), lambda top: F.zip_with(six, top, lambda x, m: F.when(x == m, x))
        ),
    )
    enough = F.size(word_hashes) >= WINDOW
    return F.when(enough, once(word_hashes, lambda one: once(grams(one), kept))).otherwise(F.array().cast("array<bigint>"))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _digest(words_: Column) -> list[Column]:
    """128 bits of a window's words."""
    text = F.concat_ws(" ", words_)
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2")]


def _marks(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """What to look for: ``h`` of long items' kept hashes, each once; and ``(h, size, at)`` of shorter items, which are one
    window of their own, found by their word of the smallest hash; and how many of these there are."""
    spark = items.sparkSession
    # Written, so that Spark knows their sizes: they are broadcast only below the session's limit.
    each = items.where(F.size("w") >= WINDOW).select(F.explode(kept_hashes(F.transform("w", lambda w: F.xxhash64(w)))).alias("h"))
    long = written(each.where("h is not null").distinct(), "marks")
    hashes = F.transform("w", lambda w: F.xxhash64(w))
    at = (F.array_position(hashes, F.array_min(hashes)) - 1).cast("int")
    short = items.where(F.size("w") < WINDOW).select(F.array_min(hashes).alias("h"), F.size("w").alias("size"), at.alias("at"))
    return long, *written_with(short.distinct(), scratch_path(spark, "short-marks"), F.count(F.lit(1)))


def _windows(items: DataFrame) -> DataFrame:
    """``(d1, d2, item_id)``: each window of each item once."""
    size = F.least(F.size("w"), F.lit(WINDOW))
    firsts = F.sequence(F.lit(0), F.size("w") - size)
    each = items.select("item_id", F.explode(F.transform(firsts, lambda i: F.struct(*_digest(F.slice("w", i + 1, size))))).alias("d"))
    return written(each.select("d.d1", "d.d2", "item_id").distinct(), "item-windows")


def _candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(key, places)``: for each document that shares a kept hash with an item, structs ``(size, first, last)``: windows
    of so many words that begin at these places may be an item's.

    A hash is met once, however often an item repeats it, so a text of one word that comes a million times has a
    million rows here, whatever the items are.
    """
    long, short, some = _marks(items)
    hit = docs.select("key", F.posexplode(kept_hashes(_hashes(F.col("text")))).alias("place", "h")).where("h is not null")
    found = hit.join(long, "h", "left_semi").select("key", F.lit(WINDOW).alias("size"), (F.col("place") - (WINDOW - GRAM)).alias("first"), F.col("place").alias("last"))
    if some:
        each = docs.select("key", F.posexplode(_hashes(F.col("text"))).alias("place", "h")).join(short, "h")
        at = F.col("place") - F.col("at")
        found = found.unionByName(each.select("key", "size", at.alias("first"), at.alias("last")))
    return found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("size", "last", "first"))).alias("places"))


def _extended(words_: Column, places: Column) -> Column:
    """The windows at the places of a document, ``(first, last, d1, d2)``: a window of several places is taken once."""
    def of_place(p: Column, q: Column) -> Column:
        # Places are sorted, so what the one before has taken is left out.
        low = F.when(q["size"] == p["size"], F.greatest(p["first"], q["last"] + 1)).otherwise(p["first"])
        low, high = F.greatest(low, F.lit(0)), F.least(p["last"], F.size(words_) - p["size"])
        starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.struct(s.alias("first"), (s + p["size"] - 1).alias("last"), *_digest(F.slice(words_, s + 1, p["size"]))))

    # The first place has none before it.
    nothing = F.transform(F.slice(places, F.lit(1), F.lit(1)), lambda p: p.withField("size", F.lit(0)))
    before = F.concat(nothing, F.slice(places, F.lit(1), F.size(places) - 1))
    return F.flatten(F.zip_with(places, before, of_place))


def _spans(hits: DataFrame) -> DataFrame:
    """``(key, hit_spans, n_hit)``: disjoint spans in order, from the windows that are hit."""
    order = Window.partitionBy("key").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = hits.withColumn("_begins", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
    span = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    each = begun.withColumn("_span", span).groupBy("key", "_span").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return each.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("hit_spans"), F.sum(F.col("last") - F.col("first") + 1).alias("n_hit")
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_spans`` (first and last word), ``item_ids`` and ``contaminated``.

    ``benchmark`` has ``item_id`` and ``text``. A window is 13 consecutive words of an item, or all words of a shorter
    one; a document's word is hit if it stands inside an occurrence of a window. Contaminated: some word is hit and at
    least one in 20. Every row of ``docs`` is returned, repeated rows and null ids too; a null or empty text has no
    words and isn't contaminated. An item without words has no window; an item with a null id hits words, but is not
    listed. An empty benchmark hits nothing. Columns of ``docs`` named like the new ones are replaced. A very long text
    costs time and memory in proportion to its words, also if it repeats itself.

    Plan: one narrow pass turns texts into kept hashes, which meet the benchmark's in an equality join. Documents with
    hits are read again and the windows at the hits compared by digests of 128 bits, in a second equality join. Only
    these documents' texts are shuffled, and no group of documents is ever gathered.
    """
    own = ("n_words", "n_hit", "hit_spans", "item_ids", "contaminated", "_key", "_text", "_maybe", "_page", "_bits", "_begins", "_span")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    # A row is known by its id and text.
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col("text"))
    items = written(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct(),
        "items",
    )
    places = written(_candidates(docs.where("text is not null").select(key.alias("key"), "text"), items), "places")
    read = sieved(docs.where("text is not null").select(key.alias("_key"), F.col("text")), F.col("_key"), places.select("key")).where("_maybe")
    # What is found grows with the documents, so it is never broadcast by a hint; texts are hashed to it, but not sorted.
    again = read.select(F.col("_key").alias("key"), "text").join(places.hint("shuffle_hash"), "key")
    windows = again.select("key", F.explode(once(words(F.col("text")), lambda w: _extended(w, F.col("places")))).alias("x")).select("key", "x.*")
    known = _windows(items)
    hits = written(windows.join(known.select("d1", "d2").distinct(), ["d1", "d2"], "left_semi").distinct(), "window-hits")
    of_items = hits.select("key", "d1", "d2").distinct().join(known.where("item_id is not null"), ["d1", "d2"]).select("key", "item_id").distinct()
    ids = of_items.groupBy("key").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    found = written(_spans(hits).join(ids, "key", "left").withColumnRenamed("key", "_key"), "hits")

    # Words are counted behind the sieve, so once a row, and before the join, so that texts needn't go through it.
    told = sieved(docs.select(*kept, key.alias("_key"), F.col("text").alias("_text")), F.col("_key"), found.select("_key"))
    n_words = F.size(words(F.col("_text"))).cast("long").alias("n_words")
    none = [
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<struct<first:int,last:int>>").alias("hit_spans"),
        F.array().cast("array<string>").alias("item_ids"),
    ]
    met = told.where("_maybe").select(*kept, "_key", n_words).join(found.hint("shuffle_hash"), "_key", "left")
    filled = [F.coalesce(F.col(x), y).alias(x) for x, y in zip(("n_hit", "hit_spans", "item_ids"), none)]
    others = told.where(~F.col("_maybe")).select(*kept, n_words, *none)
    rows = met.select(*kept, "n_words", *filled).unionByName(others)
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


#: Windows as text, joined one by one.
ORACLE = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
il as (select item_id, w, least(13, len(w)) l from iw where len(w) > 0),
ig as (select item_id, l, unnest(list_transform(range(0, len(w) - l + 1), lambda i: array_to_string(w[i + 1:i + l], ' '))) g from il),
sizes as (select distinct l from il),
dp as (select doc_id, l, unnest(range(0, len(w) - l + 1)) p, unnest(list_transform(range(0, len(w) - l + 1), lambda i: array_to_string(w[i + 1:i + l], ' '))) dg from dw, sizes where len(w) >= l),
hit as (select doc_id, p, dp.l, item_id from dp join ig on ig.l = dp.l and g = dg),
n as (select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + l)) q from hit) group by doc_id),
i as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct doc_id, item_id::varchar item_id from hit where item_id is not null) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from dw left join n using (doc_id) left join i using (doc_id)
"""
