"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling.

Trained on every labelled document that isn't held out, in rounds: tasks take steps from the same net on parts of the
documents, and the next round's net is the mean of theirs. Thresholds are counted over all calibrating documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import sieved, table
from linkmill.llm.hashing import Tokens, batches
from linkmill.session import written

#: Rows of the embedding table and numbers per row. A word is the sum of the rows of its hash and of the hashes of
#: its beginnings of these lengths in bytes, so that forms of a word share most of what is learnt.
ROWS, WIDTH, BEGINNINGS = 1 << 16, 16, (4, 5, 6, 7)
#: Words that a filter sees, and filters of each such width.
SPANS, FILTERS = (1, 2, 3), 8
#: Rounds, passes over all training texts in each, texts of a step, step size, and shrinking of embeddings towards zero.
ROUNDS, PASSES, BATCH, RATE, DECAY = 4, 2, 32, 0.1, 1e-4
#: Words that are convolved at a time, and characters of texts that a task holds at a time, or one text if that is longer.
PLACES, HELD_CHARS = 1 << 14, 8_000_000
#: Labelled documents of a part, about, and rows of the net that are averaged together.
PART, BLOCK = 5_000, 512
#: Scores are counted in so many steps of equal width, so thresholds lie between two steps.
STEPS = 10_000
#: Bounds of ``labelled_sample``, which ``classify`` doesn't use.
TRAINED, TRAINED_CHARS, CALIBRATED, LANGUAGES = 2_500, 20_000, 500, 64
#: The score from which the registered query predicts toxic.
CUT = 0.7
SEED = 42


def word_rows(tokens: Tokens) -> np.ndarray:
    """Embedding rows of each word: of the whole word and of its beginnings; shorter words repeat their whole hash."""
    lengths = (None, *BEGINNINGS)
    found = [(tokens.hashes(n) % np.uint64(ROWS - 1)).astype(np.int32) + 1 for n in lengths]
    return np.stack(found, axis=1)[tokens.is_word]


class Net:
    """The classifier's numbers. Row 0 of the embeddings stays zero: it stands for the empty places around texts."""

    def __init__(self, rng: np.random.Generator):
        self.embedding = (rng.normal(size=(ROWS, WIDTH)) * 0.05).astype(np.float32)
        self.embedding[0] = 0
        scale = {n: 1 / np.sqrt(n * WIDTH) for n in SPANS}
        self.filters = {n: (rng.normal(size=(n, WIDTH, FILTERS)) * scale[n]).astype(np.float32) for n in SPANS}
        self.offsets = {n: np.zeros(FILTERS, np.float32) for n in SPANS}
        self.weights = (rng.normal(size=len(SPANS) * FILTERS) * 0.3).astype(np.float32)
        self.offset = np.float32(-1)

    def words(self, rows: np.ndarray) -> np.ndarray:
        """The embedding of each word: the sum of its rows."""
        x = self.embedding[rows[:, 0]]
        for j in range(1, rows.shape[1]):
            x += self.embedding[rows[:, j]]
        return x

    def convolved(self, x: np.ndarray) -> dict[int, np.ndarray]:
        """For each span, the filters' values at every place of ``x``; a span reaches into the rows after its place."""
        found = {}
        for n in SPANS:
            z = x @ self.filters[n][0] + self.offsets[n]
            for j in range(1, n):
                z[:-j] += x[j:] @ self.filters[n][j]
            found[n] = z
        return found

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The largest value of each filter in each text; texts, with the empty places before them, begin at ``starts``."""
        found = self.convolved(self.words(rows))
        ends = len(rows) - max(SPANS) + 1  # the last empty places are nobody's
        return np.concatenate([np.maximum.reduceat(found[n][:ends], starts, axis=0) for n in SPANS], axis=1)

    def score(self, texts: Sequence[str]) -> np.ndarray:
        """A score from 0 to 1 for each text, over all of its words."""
        gap = max(SPANS) - 1
        empty = np.zeros((gap, 1 + len(BEGINNINGS)), np.int32)
        best = np.full((len(texts), len(SPANS) * FILTERS), -np.inf, np.float32)
        # A long text may come in several parts: its last places wait until it is known what follows them.
        waiting: tuple[int, np.ndarray] | None = None

        def see(text: int, places: np.ndarray) -> None:
            found = self.convolved(self.words(places))
            top = np.concatenate([found[n][: len(places) - gap].max(axis=0) for n in SPANS])
            best[text] = np.maximum(best[text], top)

        for first, n, tokens, row in batches(texts):
            words = word_rows(tokens)
            if waiting and waiting[0] != first:
                see(waiting[0], np.concatenate([waiting[1], empty]))
                waiting = None
            if n == 1:
                places = np.concatenate([waiting[1] if waiting else empty, words])
                if len(places) > gap:
                    see(first, places)
                waiting = (first, places[-gap:])
            else:
                laid, starts = laid_out(words, row[tokens.is_word], n)
                best[first : first + n] = self.pooled(laid, starts)
        if waiting:
            see(waiting[0], np.concatenate([waiting[1], empty]))
        z = np.maximum(best, 0) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -50, 50)))


def laid_out(words: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``n`` texts one after another, empty places before each text and after the last, so that no span holds
    words of two texts; with the place where each text's own empty places begin."""
    gap = max(SPANS) - 1
    counts = np.bincount(of, minlength=n)
    starts = np.concatenate([[0], np.cumsum(counts + gap)[:-1]])
    laid = np.zeros((len(words) + (n + 1) * gap, words.shape[1]), np.int32)
    laid[np.arange(len(words)) + (of + 1) * gap] = words
    return laid, starts


def words_of(texts: Sequence[str]) -> list[np.ndarray]:
    """The embedding rows of each text's words."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for first, n, tokens, row in batches(texts):
        # A row's number fits into 16 bits, as ROWS says.
        words = word_rows(tokens).astype(np.uint16)
        ends = np.searchsorted(row[tokens.is_word], np.arange(1, n))
        for k, own in enumerate(np.split(words, ends)):
            found[first + k].append(own)
    return [np.concatenate(own) for own in found]


class Trainee:
    """A net in training, with the sums of squared slopes (Adagrad) that scale its steps: one for each row of the
    embeddings and one for each other number; and how many steps touched each row of its table."""

    OTHERS = sum(SPANS) * WIDTH * FILTERS + 2 * len(SPANS) * FILTERS + 1
    #: Rows of the table that hold the other numbers, or their squares.
    ROWS_OF_OTHERS = -(-OTHERS // WIDTH)

    def __init__(self, net: Net):
        self.net = net
        self.squares = np.full(ROWS, 1e-3, np.float32)
        self.other_squares = np.full(self.OTHERS, 1e-3, np.float32)
        self.seen = np.zeros(ROWS + 2 * self.ROWS_OF_OTHERS, np.int64)

    def table(self) -> np.ndarray:
        """All numbers as rows of ``WIDTH`` and a last column: the embeddings with their squares, then the others, then
        the others' squares."""
        found = np.zeros((len(self.seen), WIDTH + 1), np.float32)
        found[:ROWS, :WIDTH], found[:ROWS, WIDTH] = self.net.embedding, self.squares
        for k, numbers in enumerate((self._others(), self.other_squares)):
            own = np.zeros(self.ROWS_OF_OTHERS * WIDTH, np.float32)
            own[: self.OTHERS] = numbers
            found[ROWS + k * self.ROWS_OF_OTHERS :][: self.ROWS_OF_OTHERS, :WIDTH] = own.reshape(-1, WIDTH)
        return found

    @classmethod
    def of(cls, table_: np.ndarray) -> Trainee:
        """The trainee of a table, which stays as it is."""
        found = cls(Net(np.random.default_rng(SEED)))
        found.net.embedding, found.squares = table_[:ROWS, :WIDTH].copy(), table_[:ROWS, WIDTH].copy()
        others, found.other_squares = (
            table_[ROWS + k * cls.ROWS_OF_OTHERS :][: cls.ROWS_OF_OTHERS, :WIDTH].reshape(-1)[: cls.OTHERS].copy() for k in range(2)
        )
        found._set_others(others)
        return found

    def _others(self) -> np.ndarray:
        net = self.net
        return np.concatenate(
            [*[net.filters[n].ravel() for n in SPANS], *[net.offsets[n] for n in SPANS], net.weights, [net.offset]]
        ).astype(np.float32)

    def _set_others(self, numbers: np.ndarray) -> None:
        net, at = self.net, 0
        for places in (net.filters, net.offsets):
            for n in SPANS:
                size = places[n].size
                places[n] = numbers[at : at + size].reshape(places[n].shape).copy()
                at += size
        net.weights, net.offset = numbers[at:-1].copy(), np.float32(numbers[-1])

    def tops(self, texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and filter the largest value, and the embedding rows of the words it comes from. Long texts are
        convolved piece by piece."""
        gap, filters = max(SPANS) - 1, len(SPANS) * FILTERS
        best = np.full((len(texts), filters), -np.inf, np.float32)
        windows = np.zeros((len(texts), filters, gap + 1, 1 + len(BEGINNINGS)), np.uint16)
        empty = np.zeros((gap, 1 + len(BEGINNINGS)), np.uint16)

        def see(pieces: list[tuple[int, np.ndarray]]) -> None:
            laid = np.concatenate([piece for _, piece in pieces])
            found = self.net.convolved(self.net.words(laid))
            values, at = np.concatenate([found[n] for n in SPANS], axis=1), 0
            for text, piece in pieces:
                own = values[at : at + len(piece) - gap]
                place = own.argmax(axis=0)
                top = own[place, np.arange(filters)]
                better = top > best[text]
                best[text, better] = top[better]
                windows[text, better] = laid[at + place[better][:, None] + np.arange(gap + 1)]
                at += len(piece)

        waiting, size = [], 0
        for text, words in enumerate(texts):
            for start in range(0, len(words) + gap, PLACES):
                # Places before the words, the words, places after them; a piece ends with what its last span reaches.
                piece = words[max(start - gap, 0) : start + PLACES]
                if start == 0:
                    piece = np.concatenate([empty, piece])
                if (short := min(PLACES, len(words) + gap - start) + gap - len(piece)) > 0:
                    piece = np.concatenate([piece, empty[:short]])
                if waiting and size + len(piece) > PLACES:
                    see(waiting)
                    waiting, size = [], 0
                waiting.append((text, piece))
                size += len(piece)
        if waiting:
            see(waiting)
        return best, windows

    def step(self, texts: Sequence[np.ndarray], toxic: np.ndarray, weight: np.ndarray) -> None:
        """One step down the weighted logistic loss of the texts. Only words under a filter's largest value have a slope."""
        net = self.net
        best, windows = self.tops(texts)
        hidden = np.maximum(best, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.weights + net.offset, -30, 30)))
        slope = ((p - toxic) * weight / len(texts)).astype(np.float32)
        back = (np.outer(slope, net.weights) * (hidden > 0)).astype(np.float32)
        filters = np.zeros((len(SPANS) * FILTERS, max(SPANS), WIDTH), np.float32)
        for k, n in enumerate(SPANS):
            filters[k * FILTERS : (k + 1) * FILTERS, :n] = net.filters[n].transpose(2, 0, 1)
        filter_, text = np.nonzero(back.T)
        rows, pull = windows[text, filter_], back[text, filter_]
        x = net.embedding[rows].sum(axis=2)
        by_filter = np.zeros_like(filters)
        if len(filter_):
            first = np.flatnonzero(np.diff(filter_, prepend=-1))
            by_filter[filter_[first]] = np.add.reduceat(pull[:, None, None] * x, first, axis=0)
        sizes = [by_filter[k * FILTERS : (k + 1) * FILTERS, :n].transpose(1, 2, 0).ravel() for k, n in enumerate(SPANS)]
        others = np.concatenate([*sizes, back.sum(axis=0), hidden.T @ slope, [slope.sum()]]).astype(np.float32)
        self.other_squares += others**2
        scaled = RATE * others / np.sqrt(self.other_squares)
        scaled[-1] = RATE * others[-1]
        x_slope = (pull[:, None, None] * filters[filter_]).reshape(-1, WIDTH)
        self._set_others(self._others() - scaled)
        self.seen[ROWS:] += 1

        # Rows of the embeddings: a place's slope goes to each row whose sum its word is.
        inside = np.array([j < SPANS[k // FILTERS] for k in range(len(filters)) for j in range(max(SPANS))])
        used = inside.reshape(len(filters), -1)[filter_].ravel()
        ids = rows.reshape(-1, rows.shape[-1])[used]
        order = np.argsort(ids, axis=None, kind="stable")
        ids, of = ids.ravel()[order], order // rows.shape[-1]
        of, ids = of[ids > 0], ids[ids > 0]
        if len(ids):
            first = np.flatnonzero(np.diff(ids, prepend=-1))
            touched = ids[first]
            gradient = np.add.reduceat(x_slope[used][of], first, axis=0) + DECAY * net.embedding[touched]
            self.squares[touched] += (gradient**2).mean(axis=1)
            net.embedding[touched] -= RATE * gradient / np.sqrt(self.squares[touched])[:, None]
            self.seen[touched] += 1

    def fit(self, texts: Sequence[str], toxic: np.ndarray, share: float, rng: np.random.Generator, passes: int) -> None:
        """Passes over texts in random order. ``share`` is that of toxic documents among all: both labels weigh the same
        in total."""
        words = words_of(texts)
        toxic = np.asarray(toxic, bool)
        weight = np.where(toxic, 0.5 / share, 0.5 / (1 - share))
        for _ in range(passes):
            order = rng.permutation(len(words))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                self.step([words[i] for i in chosen], toxic[chosen], weight[chosen])


def one_sided(toxic: bool) -> Net:
    """A net that scores one label's side for every text."""
    net = Net(np.random.default_rng(SEED))
    net.weights[:] = 0
    net.offset = np.float32(2 if toxic else -2)
    return net


def train(texts: Sequence[str], labels: np.ndarray, seed: int = SEED) -> Net:
    """Fit on texts in one process by logistic loss with scaled steps (Adagrad); one label only gives that label's side
    for every text."""
    rng = np.random.default_rng(seed)
    toxic = np.asarray(labels) == 1
    if not toxic.any() or toxic.all():
        return one_sided(bool(len(toxic) and toxic.all()))
    trainee = Trainee(Net(rng))
    trainee.fit(texts, toxic, toxic.mean(), rng, ROUNDS * PASSES)
    return trainee.net


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """Every labelled document that isn't held out, written once: ``(part, toxic, text, lang, calibrates)``.

    An id counts once, by the text with the smallest hash, however often it occurs; one in five calibrates. A part is a
    hash class of ids in a file of its own, and holds the ids in order. Texts are shuffled once, only those that a sieve
    of the labelled ids lets pass.
    """
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .where(~is_held_out(F.col("id")))
    )
    known = written(known, "labelled-ids")
    parts = max(1, math.ceil(known.count() / PART))
    plain = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    usable = plain.where(F.col("id").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("id")))
    # The id as text, as ids of two tables may be numbers of different types.
    id_hash = F.xxhash64(F.col("id").cast("string"))
    passed = sieved(usable, id_hash, known.select(id_hash.alias("hash"))).where("_maybe").select("id", "text", "lang")
    chosen = (
        passed.repartition(parts, "id")
        .join(known.repartition(parts, "id"), "id")
        .groupBy("id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "lang")).alias("row"), F.max("toxic").alias("toxic"))
    )
    calibrates = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(5)) == 0
    return written(chosen.select(F.spark_partition_id().alias("part"), "toxic", "row.text", "row.lang", calibrates.alias("calibrates")), "labelled")


def one_round(rows: DataFrame, start: np.ndarray, share: float, turn: int) -> np.ndarray:
    """The table of a net after one round from the table ``start``.

    Each part trains on its own from there, text by text in bounded memory. The new table is the mean of theirs, row by
    row, weighted by the steps that touched the row, so a word that few parts know isn't diluted by the others. A task
    sends the sums of its parts, at most 5 MB; there is at most one a core.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(start)  # 5 MB, as ROWS and WIDTH bound it

    def trained(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin = shared.value
        sums, seen = np.zeros(begin.shape), np.zeros(len(begin), np.int64)
        trainee = rng = part = least = None
        texts: list[str] = []
        toxic: list[int] = []

        def fit() -> None:
            if texts:
                trainee.fit(texts, np.array(toxic) == 1, share, rng, PASSES)
                texts.clear()
                toxic.clear()

        def add() -> None:
            if trainee is not None:
                fit()
                sums[:] += (trainee.table() - begin) * trainee.seen[:, None]
                seen[:] += trainee.seen

        held = 0
        for batch in batches_:
            for own, text, label in zip(batch["part"], batch["text"], batch["toxic"], strict=True):
                if own != part:
                    add()
                    trainee, rng, part, held = Trainee.of(begin), np.random.default_rng([SEED, turn, own]), own, 0
                    least = own if least is None else min(least, own)
                texts.append(text)
                toxic.append(label)
                held += len(text)
                if held >= HELD_CHARS:
                    fit()
                    held = 0
        add()
        for at in range(0, len(seen) if seen.any() else 0, BLOCK):
            told = np.concatenate([sums[at : at + BLOCK], seen[at : at + BLOCK, None]], axis=1)
            if told[:, -1].any():
                yield pd.DataFrame({"block": [at // BLOCK], "least": [least], "sums": [told.astype(np.float32).tobytes()]})

    def averaged(batches_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = total = None

        def mean() -> pd.DataFrame:
            moved = total[:, :-1] / np.maximum(total[:, -1:], 1)
            return pd.DataFrame({"block": [block], "moved": [moved.astype(np.float32).tobytes()]})

        for batch in batches_:
            for own, sums in zip(batch["block"], batch["sums"], strict=True):
                told = np.frombuffer(sums, np.float32).reshape(-1, WIDTH + 2).astype(np.float64)
                if own == block:
                    total += told
                    continue
                if block is not None:
                    yield mean()
                block, total = own, told
        if block is not None:
            yield mean()

    sent = rows.coalesce(spark.sparkContext.defaultParallelism).mapInPandas(trained, "block int, least int, sums binary")
    ordered = sent.repartition("block").sortWithinPartitions("block", "least")
    found = start.copy()
    for r in ordered.mapInPandas(averaged, "block int, moved binary").toPandas().itertuples():
        found[r.block * BLOCK :][:BLOCK] += np.frombuffer(r.moved, np.float32).reshape(-1, WIDTH + 1)
    shared.unpersist()
    return found


def trained_net(rows: DataFrame) -> Net:
    """The net of all rows ``(part, toxic, text)``."""
    n, toxic = rows.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, n):
        return one_sided(toxic > 0)
    state = Trainee(Net(np.random.default_rng(SEED))).table()
    for turn in range(ROUNDS):
        state = one_round(rows, state, toxic / n, turn)
    return Trainee.of(state).net


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str) -> pd.DataFrame:
    """Bounded rows ``(text, toxic, lang, use)`` for trials on the driver (``use`` is ``train``, or ``calibrate``). No model
    or threshold of ``classify`` comes from them.

    Only labelled documents that are not held out and short enough; of these, one in five calibrates. An id counts once,
    by the text with the smallest hash, however often it occurs. Each kind is taken in order of a hash of its id: up to
    ``TRAINED`` of a label, and up to ``CALIBRATED`` of each of the ``LANGUAGES`` with most rows. What is chosen is
    bounded and broadcast, so texts are not shuffled.
    """
    plain = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    usable = plain.where(F.length("text") <= TRAINED_CHARS)
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .where(~is_held_out(F.col("id")))
    )
    each = (
        usable.select("id", "lang", F.xxhash64("text").alias("hash"))
        .join(known, "id")
        .groupBy("id")
        .agg(F.min(F.struct("hash", "lang")).alias("row"), F.max("toxic").alias("toxic"))
        .select("id", "row.hash", "row.lang", "toxic", F.xxhash64(F.lit(SEED), "id").alias("order"))
    )
    each = written(each, "labelled")
    calibrates = F.pmod("order", F.lit(5)) == 0
    common = each.where(calibrates).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")

    def some(rows: DataFrame, by: str, limit: int, use: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(by).orderBy("order", "id"))
        return rows.withColumn("place", place).where(F.col("place") <= limit).select("id", "hash", "toxic", F.lit(use).alias("use"))

    fit = some(each.where(~calibrates), "toxic", TRAINED, "train")
    rest = some(each.where(calibrates).join(F.broadcast(common), each["lang"].eqNullSafe(common["lang"]), "left_semi"), "lang", CALIBRATED, "calibrate")
    chosen = fit.unionByName(rest).withColumnRenamed("hash", "chosen_hash")
    found = usable.join(F.broadcast(chosen), "id").where(F.xxhash64("text") == F.col("chosen_hash"))
    once = found.groupBy("id", "toxic", "use").agg(F.min(F.struct("text", "lang")).alias("row"))
    return once.orderBy("id").select("row.text", "toxic", "row.lang", "use").toPandas()


def best_cut(low: np.ndarray, high: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float | None:
    """The score with the best F1 over groups of ``n`` rows with ``hits`` toxic ones and scores from ``low`` to ``high``,
    halfway to the next lower group; None without two labels."""
    if hits.sum() in (0, n.sum()):
        return None
    order = np.argsort(-low, kind="stable")
    low, high = low[order], high[order]
    f1 = 2 * np.cumsum(hits[order]) / (np.cumsum(n[order]) + hits.sum())
    f1[:-1][low[:-1] == high[1:]] = -1
    at = int(np.argmax(f1))
    return float((low[at] + high[at + 1]) / 2) if at + 1 < len(low) else float(low[at])


def thresholds(scores: np.ndarray, toxic: np.ndarray, langs: Sequence[str | None]) -> dict[str | None, float]:
    """For each language the score with the best F1 on its calibration rows, halfway to the next lower score; a language
    with only one label has the threshold of all rows, under None, and without two labels that is ``CUT``."""
    toxic = np.asarray(toxic, bool)
    ones = np.ones(len(toxic), np.int64)
    overall = best_cut(scores, scores, ones, toxic)
    found: dict[str | None, float] = {None: CUT if overall is None else overall}
    langs = np.array([x if isinstance(x, str) else "" for x in langs], dtype=object)
    for lang in sorted(set(langs) - {""}):
        own = langs == lang
        if (cut := best_cut(scores[own], scores[own], ones[own], toxic[own])) is not None:
            found[lang] = cut
    return found


def counted_thresholds(scored: DataFrame) -> tuple[float, DataFrame]:
    """``thresholds`` of all rows ``(lang, toxic, score)``: that of all languages, and a written table ``(lang, cut)``.

    Scores are counted in ``STEPS`` steps, so a language's group has no more rows than that.
    """
    facts = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("hits").alias("hits")]
    each = scored.select(
        "lang", F.floor(F.col("score") * STEPS).alias("step"), F.col("score").alias("low"), F.col("score").alias("high"),
        F.lit(1).alias("n"), F.col("toxic").cast("long").alias("hits"),
    )
    steps = written(each.groupBy("lang", "step").agg(*facts), "calibration")

    def cut(group: pd.DataFrame) -> float | None:
        return best_cut(*[group[c].to_numpy() for c in ("low", "high", "n", "hits")])

    def of_language(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": group["lang"].iloc[:1].astype(object), "cut": [cut(group)]})

    overall = cut(steps.groupBy("step").agg(*facts).toPandas())
    own = steps.where("lang <> ''").groupBy("lang").applyInPandas(of_language, "lang string, cut double")
    return CUT if overall is None else overall, written(own.where("cut is not null"), "thresholds")


def score_column(spark: SparkSession, text: Column, net: Net) -> Column:
    shared = spark.sparkContext.broadcast(net)  # some 4 MB, as ROWS and WIDTH bound it

    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(shared.value.score(list(part)))

    return F.pandas_udf(scored, T.DoubleType())(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``threshold`` (of the row's language) and ``toxic_by_language``.

    A score comes from the whole text alone; the language only chooses the threshold beside it. Null and empty texts
    have the score of a text without words. Rows stay as they are, repeated ones too; a null id isn't held out. Columns
    named like the new ones are replaced. Without usable labels every score says not toxic; an empty table gives no rows.
    """
    own = ("held_out", "score", "threshold", "toxic_by_language")
    spark = docs.sparkSession
    known = labelled(docs, labels, doc_id, text, lang)
    net = trained_net(known.where("not calibrates"))
    rest = known.where("calibrates").select("lang", "toxic", score_column(spark, F.col("text"), net).alias("score"))
    overall, cuts = counted_thresholds(rest)
    scored = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in own],
        F.coalesce(is_held_out(F.col(f"`{doc_id}`")), F.lit(False)).alias("held_out"),
        score_column(spark, F.col(f"`{text}`"), net).alias("score"),
    )
    cuts = cuts.select(F.col("lang").alias("_cut_lang"), F.col("cut").alias("_cut"))
    met = scored.join(cuts, F.col(f"`{lang}`") == F.col("_cut_lang"), "left")
    told = met.withColumn("threshold", F.coalesce("_cut", F.lit(overall))).drop("_cut_lang", "_cut")
    return told.withColumn("toxic_by_language", F.col("score") >= F.col("threshold"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = classify(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= CUT).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, "threshold", "toxic_by_language")
