"""Personal data, and terms that give it away: information-theoretic sanitisation.

Protected entities are the addresses and numbers found by their form. How strongly a term reveals an entity is
estimated from the whole corpus: the information that the term's documents give about the entity, as a share of the
entity's own information. Terms beside the entity are generalised above one threshold and removed above another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm.common import table
from linkmill.llm.hashing import mixed, powers
from linkmill.llm.slabs import IS_GAP, LOWER, slabs, text_bytes, word_spans
from linkmill.session import scratch_path, written, written_with

#: Words on each side of an entity that are weighed against it.
NEAR = 8
#: The share of an entity's information from which a term is generalised, and from which it is removed.
GENERALISED, REMOVED = 0.6, 0.9
#: Different documents that must hold the entity with the term. Copies of a document are one, so they must be at least
#: one in ``COPIES`` of all documents that do.
EVIDENCE, COPIES = 3, 2
#: Bits of the filter of candidate terms, 1 MB at any number of terms.
FILTER_BITS = 1 << 23

KINDS = ("email", "ip", "card", "phone", "term")

# Fixed forms. An address is found from its sign, and the others begin where a run of digits does, so that a long run
# which leads nowhere is passed once.
_LOCAL = np.zeros(128, bool)
_LOCAL[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"]] = True
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others: every second one from the right is doubled."""
    total = sum(map(int, digits[-1::-2])) + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (c := ord(text[start - 1])) < 128 and _LOCAL[c]:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # What stands before the sign is looked at once: the next address begins after this one, or after its sign.
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` in order, in code points; kinds are numbers of ``KINDS``. The value is what makes
    two mentions the same entity: the address in lower case, or the digits."""
    found = [(s, 0, e, text[s:e].lower()) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end(), ".".join(p or "0" for p in parts)))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(digits := _NO_DIGITS.sub("", m.group())) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(digits := _NO_DIGITS.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end(), digits))
    found.sort(key=lambda s: s[:2])
    return found


def _hashes(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, the same wherever it stands."""
    up, down = powers(len(part) + 1)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


def _words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """Slab by slab: its rows and bytes, and begin, end, row and hash of each word, A-Z in lower case."""
    for slab in slabs(data, offsets, IS_GAP):
        part = LOWER[data[slab.start : slab.end]]
        bounds = np.clip(offsets[slab.first : slab.last + 1], slab.start, slab.end) - slab.start
        start, end, row = word_spans(part, bounds)
        yield slab, part, start, end, row, _hashes(part, start, end)


def terms_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end in code points, and hash, of each word of one text."""
    starts, ends, keys, points = [], [], [], 0
    for _, part, start, end, _, key in _words(raw, np.array([0, len(raw)])):
        point = np.zeros(len(part) + 1, np.int64)
        np.cumsum((part & 0xC0) != 0x80, out=point[1:])
        starts.append(point[start] + points)
        ends.append(point[end] + points)
        keys.append(key)
        points += int(point[-1])
    return tuple(np.concatenate(x) for x in (starts, ends, keys))


def sketch(keys: np.ndarray) -> int:
    """A number that copies of a document share: the smallest hash of three neighbouring words. A near copy keeps it
    unless that place, or a smaller one, is among what was changed."""
    if len(keys) < 3:
        return int(mixed(keys * np.uint64(3)).sum(dtype=np.uint64).view(np.int64))
    return int(mixed(keys[:-2] + mixed(keys[1:-1] + mixed(keys[2:]))).min().view(np.int64))


def contexts(raw: np.ndarray, spans: list[tuple[int, int, int, str]]) -> tuple[list, np.ndarray, int]:
    """The text's entities, a row ``(entity's number, term, first, start, end)`` for each term near one, and the sketch.

    The words nearest to a mention count, ``NEAR`` on each side, without those inside spans. ``first`` is 1 once for
    each entity and term of the text.
    """
    start, end, key = terms_of(raw)
    edge = np.array([(s, e) for s, _, e, _ in spans], np.int64)
    # Spans of different kinds may overlap; a word is free if no span that begins before its end reaches into it.
    reach = np.maximum.accumulate(edge[:, 1])
    last = np.searchsorted(edge[:, 0], end, side="left") - 1
    free = (last < 0) | (reach[np.maximum(last, 0)] <= start)
    start, end, key, of_text = start[free], end[free], key[free], sketch(key)
    names = [f"{KINDS[k]}:{v}" for _, k, _, v in spans]
    number = {n: i for i, n in enumerate(dict.fromkeys(names))}
    low = np.searchsorted(start, edge[:, 0])
    high = np.searchsorted(start, edge[:, 1])
    place = np.concatenate([low[:, None] - 1 - np.arange(NEAR), high[:, None] + np.arange(NEAR)], axis=1)
    entity = np.broadcast_to(np.array([number[n] for n in names])[:, None], place.shape)
    real = (place >= 0) & (place < len(start))
    rows = np.unique(np.stack([entity[real], place[real]]), axis=1)
    term = key[rows[1]]
    first = np.zeros(rows.shape[1], np.int64)
    order = np.lexsort([term, rows[0]])
    new = np.ones(len(order), bool)
    new[1:] = (term[order][1:] != term[order][:-1]) | (rows[0][order][1:] != rows[0][order][:-1])
    first[order[new]] = 1
    return list(number), np.stack([rows[0], term.view(np.int64), first, start[rows[1]], end[rows[1]]]), of_text


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_SCAN = "base array<struct<start:bigint,kind:int,end:bigint>>, entity bigint, term bigint, first bigint, start bigint, end bigint, sketch bigint, is_doc boolean"

_COLUMNS = ["doc_id", "place", "base", "entity", "term", "first", "start", "end", "sketch", "is_doc"]
#: A batch of rows near entities ends with a text of more rows than this, or after so many texts.
_ROWS, _TEXTS = 50_000, 1_000


def _entity_ids(names: list[str]) -> np.ndarray:
    raw = [n.encode() for n in names]
    end = np.cumsum([len(r) for r in raw])
    part = np.frombuffer(b"".join(raw), np.uint8)
    return _hashes(part, end - [len(r) for r in raw], end).view(np.int64)


def _rows_near(parts: list[list[np.ndarray]], id_type: pa.DataType) -> pa.RecordBatch:
    """Rows of entities, which have three columns, and of the terms near them, which have six."""
    n = [len(p[0]) for p in parts]
    place, entity, of_text = (np.concatenate([p[c] for p in parts]) for c in range(3))
    term, start, end = (pa.concat_arrays([pa.array(p[c]) if len(p) > 3 else pa.nulls(k, pa.int64()) for p, k in zip(parts, n)]) for c in (3, 5, 6))
    first = np.concatenate([p[4] if len(p) > 3 else np.ones(k, np.int64) for p, k in zip(parts, n)])
    arrays = [pa.nulls(len(place), id_type), pa.array(place), pa.nulls(len(place), _SPAN), pa.array(entity), term, pa.array(first), start, end, pa.array(of_text)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(np.zeros(len(place), bool))], names=_COLUMNS)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document a row with its base spans; for each of its entities, and each term near it, a row of its own."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        size = len(offsets) - 1
        from_, to = offsets[0], offsets[-1]
        part = data[from_:to]
        signs = np.flatnonzero((part == ord("@")) | ((part >= 48) & (part <= 57)))
        some = np.diff(np.searchsorted(signs, offsets - from_)) > 0
        places = batch.column(1).to_numpy()
        bases: list = [[] for _ in range(size)]
        parts: list[list[np.ndarray]] = []
        for i in np.flatnonzero(some):
            raw = data[offsets[i] : offsets[i + 1]]
            spans = base_spans(raw.tobytes().decode())
            if not spans:
                continue
            bases[i] = [{"start": s, "kind": k, "end": e} for s, k, e, _ in spans]
            entities, rows, of_text = contexts(raw, spans)
            ids = _entity_ids(entities)
            parts.append([np.full(len(ids), places[i]), ids, np.full(len(ids), of_text)])
            parts.append([np.full(rows.shape[1], places[i]), ids[rows[0]], np.full(rows.shape[1], of_text), *rows[1:]])
            if sum(len(p[0]) for p in parts[-2:]) > _ROWS or len(parts) >= 2 * _TEXTS:
                yield _rows_near(parts, batch.column(0).type)
                parts = []
        if parts:
            yield _rows_near(parts, batch.column(0).type)
        none = pa.nulls(size, pa.int64())
        arrays = [batch.column(0), batch.column(1), pa.array(bases, _SPAN), none, none, none, none, none, none, pa.array(np.ones(size, bool))]
        yield pa.RecordBatch.from_arrays(arrays, names=_COLUMNS)


def term_frequencies(texts: DataFrame, candidates: DataFrame, text: str = "text") -> DataFrame:
    """``(term, n_docs)``: in how many rows of ``texts`` each candidate stands, and perhaps some other terms.

    Words are sifted before they are shuffled by a bit map of fixed size, made from the candidates as bit maps are
    merged; what it lets through needlessly is lost in the next join. Rows are counted once a batch and term.
    """
    spark = texts.sparkSession
    bit = F.pmod("term", F.lit(FILTER_BITS)) + 1  # buckets begin with number 1
    maps = candidates.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    sieve = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.collect():  # at most FILTER_BITS bits
        sieve[(row.at - 1) * len(row.bits) : row.at * len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    shared = spark.sparkContext.broadcast(sieve)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept_rows, kept_terms = [], []
            for slab, _, _, _, row, key in _words(*text_bytes(batch.column(0))):
                place = np.mod(key.view(np.int64), FILTER_BITS)
                met = np.flatnonzero(shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                pairs = np.unique(np.stack([row[met] + slab.first, key[met].view(np.int64)]), axis=1)
                kept_rows.append(pairs[0])
                kept_terms.append(pairs[1])
            if not kept_rows:
                continue
            pairs = np.unique(np.stack([np.concatenate(kept_rows), np.concatenate(kept_terms)]), axis=1)
            terms, n = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n.astype(np.int64))], names=["term", "n"])

    rows = texts.select(F.col(f"`{text}`")).mapInArrow(count, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n_docs"))


def disclosure(n: Column, with_entity: Column, with_term: Column, both: Column) -> Column:
    """The share of an entity's information that a term gives away: their pointwise mutual information by the entity's
    own; 1 if every document of the term has the entity, 0 if every document has the entity."""
    information = F.log(n / with_entity)
    return F.when(information > 0, F.log(n * both / (with_entity * with_term)) / information).otherwise(F.lit(0.0))


def find_personal_data(docs: DataFrame, place: str | None = None) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, place, base, terms``; spans are ``(start, kind, end)`` in code points.

    ``base`` holds email, ip, card and phone spans; ``terms`` has ``(start, end, share)`` of each term near an entity
    of the text that gives away at least ``GENERALISED`` of its information, according to all documents. ``place``
    names a column that tells rows apart; without it rows are numbered. Repeated rows count each, as documents and in
    the result. Null and empty texts have no spans; an empty table gives no rows; other columns are not read.

    1. A narrow pass finds entities and the terms near them, a number of rows that grows with the entities.
    2. Counts of (entity, term) combine map-side; only pairs with enough evidence go on.
    3. A second narrow pass counts documents of those terms.
    4. Pairs above the threshold meet the rows of step 1 again. Entities and terms are never gathered anywhere.
    """
    spark = docs.sparkSession
    number = F.monotonically_increasing_id() if place is None else F.col(f"`{place}`").cast("long")
    sent = docs.select(F.col("doc_id"), number.alias("place"), F.col("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, place bigint, {_SCAN}"
    scanned, n = written_with(sent.mapInArrow(_scan, schema), scratch_path(spark, "entities"), F.count_if("is_doc"))
    found = scanned.where("not is_doc")
    per_copy = found.groupBy("entity", "term", "sketch").agg(F.sum("first").alias("n"))
    counts = written(per_copy.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")), "entity-terms")
    pairs = counts.where(F.col("term").isNotNull() & (F.col("copies") >= EVIDENCE) & (F.col("copies") * COPIES >= F.col("n")))
    entities = counts.where("term is null").select("entity", F.col("n").alias("n_entity"))
    frequencies = written(term_frequencies(docs, pairs), "terms")
    share = disclosure(F.lit(float(n)), F.col("n_entity"), F.col("n_docs"), F.col("n"))
    telling = written(
        pairs.drop("copies").join(entities, "entity").join(frequencies, "term").select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISED),
        "telling",
    )
    marked = found.where("term is not null").join(telling, ["entity", "term"]).groupBy("place", "start", "end").agg(F.max("share").alias("share"))
    of_text = marked.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    rows = scanned.where("is_doc").select("doc_id", "place", "base").join(of_text, "place", "left")
    return rows.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,share:double>>")))


def listed(spans: Column) -> Column:
    """Spans ``(start, kind, end)`` as ``kind:start:end``, by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _without(text: str, base: list, terms: list) -> str:
    """The text with base spans and terms replaced; where spans overlap, the first one's label stands for both."""
    spans = [(s["start"], s["end"], f"<{KINDS[s['kind']].upper()}>") for s in base]
    for t in terms:
        word = text[t["start"] : t["end"]]
        general = "<NUMBER>" if word.isdecimal() else "<NAME>" if word[:1].isupper() else "<WORD>"
        spans.append((t["start"], t["end"], "" if t["share"] >= REMOVED else general))
    out, done = [], 0
    for start, end, label in sorted(spans):
        if start >= done:
            out += [text[done:start], label]
        done = max(done, end)
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sanitised``: personal data replaced by its kind, telling terms by what they are, or removed.

    The rows are written once with a number each, by which spans meet texts again; a null text stays null. A column of
    ``docs`` with the new one's name is replaced.
    """
    own = ("sanitised", "_place", "_spans")
    kept = [c for c in docs.columns if c not in own]
    placed = written(docs.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias("_place")), "placed")
    found = find_personal_data(placed, "_place").select(F.col("place").alias("_place"), F.struct("base", "terms").alias("_spans"))
    joined = placed.join(found.where(F.size("_spans.base") > 0), "_place", "left")

    @F.pandas_udf("string")
    def replaced(text, spans):
        return pd.Series([_without(t, b, s) if t and b is not None else t for t, b, s in zip(text, spans["base"], spans["terms"])], dtype=object)

    return joined.select(*[F.col(f"`{c}`") for c in kept], replaced(F.col("text"), F.col("_spans")).alias("sanitised"))


def op12_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    added = F.transform("terms", lambda t: F.struct(t["start"], F.lit(KINDS.index("term")).alias("kind"), t["end"]))
    return found.select(
        "doc_id",
        *[F.size(F.array_compact(F.transform("base.kind", lambda k: F.when(k == i, k)))).cast("long").alias(f"n_{name}") for i, name in enumerate(KINDS[:4])],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", added)).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )
