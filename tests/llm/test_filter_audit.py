import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from linkmill.llm import filter_audit, slabs
from linkmill.llm.filter_audit import COUNTS, SpanTable, audit, op11_filter_audit, transduce, with_counts
from linkmill.llm.slabs import text_bytes

DOCS = "doc_id long, lang string, text string, n_words string"
LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    text = text or ""
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


TEXTS = [
    None, "", " ", "a", "A", "a a A", "é É x é", "日本 日本\t語", "🙂 🙂🙂 x", "#$%&*| & -", "\n\x0b\x0c\r a\x1c b", "x" * 3000, " " * 3000, "Ab " * 400,
    "end", "start", "end ", " start", "\x00 \x00a \x00", "à à",
]


@pytest.mark.parametrize("slab", [1, 7, 64, 1 << 19])
def test_counts_equal_plain_loops_in_slabs_of_any_size(monkeypatch, slab):
    monkeypatch.setattr(slabs, "SLAB", slab)
    rng = random.Random(slab)
    some = ["".join(rng.choice("aAbé \n#日") for _ in range(rng.randrange(200))) for _ in range(100)]
    texts = TEXTS + some
    assert transduce(*text_bytes(pa.array(texts))).tolist() == [plain(t) for t in texts]
    sliced = pa.array(texts)[3:40]
    assert transduce(*text_bytes(sliced)).tolist() == [plain(t) for t in texts[3:40]]
    assert transduce(*text_bytes(pa.array(texts, pa.large_string()))).tolist() == [plain(t) for t in texts]


def test_equal_keys_of_different_words_are_told_apart():
    words = [b"ab", b"cd", b"ab", b"abc", b"cd", b"xy"]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    known = SpanTable(data, 1)
    key, row = np.zeros(len(words), np.uint64), np.zeros(len(words), np.int64)
    assert len(known.insert(start, end, key, row)) == 4
    assert len(known.insert(start, end, key, row)) == 0
    assert len(known.insert(start[:1], end[:1], key[:1], row[:1] + 1)) == 1


def test_very_long_text(spark):
    text = " ".join(f"w{i % 70_000}" for i in range(700_000)) + "#"
    docs = spark.createDataFrame([(1, "en", text, None)], DOCS)
    row = with_counts(docs).first()
    assert [row[c] for c in COUNTS] == plain(text) and row.doc_id == 1


def by_hand(docs, labels):
    firsts, bits = {}, []
    for i, lang, text in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    for i, lang, text in docs:
        n, d, c, p, s = plain(text)
        fails = {f for f, x in zip("ABCDE", (n < 200, 100 * d < 50 * n, 100 * c > 3 * p, s > 0, i is not None and firsts[text or ""] < i), strict=True) if x}
        good = any(k == i and q == 1 for k, q, _ in labels if k is not None)
        bad = any(k == i and t == 1 for k, _, t in labels if k is not None)
        bits.append((lang or "", fails, good, bad))
    found = {}
    for order in map("".join, permutations("ABCDE")):
        for part in {b[0] for b in bits}:
            left = [b for b in bits if b[0] == part]
            every = list(left)
            for step, f in enumerate(order, 1):
                gone = [b for b in left if f in b[1]]
                left = [b for b in left if f not in b[1]]
                found[part, order, step] = [
                    len(left), len(gone), sum(f in b[1] for b in every) - len(gone), sum(b[1] == {f} for b in every),
                    sum(b[2] for b in gone), sum(b[3] for b in gone),
                ]
    shapley = {}
    for (part, order, step), row in found.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + row[1]
    return {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in found.items()}


def test_orders_equal_brute_force_with_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(5)
    docs = []
    for i in range(120):
        n = rng.choice([0, 3, 150, 220, 260])
        words = [f"{rng.choice(['W', 'w'])}{rng.randrange(rng.choice([20, 2000]))}" for _ in range(n)] + ["#"] * rng.choice([0, 0, 1])
        docs.append((i, rng.choice(["en", "de", None, ""]), " ".join(words)))
    docs += [(200 + i, "en", docs[7][2]) for i in range(40)] + [(None, "en", docs[7][2]), (None, None, None), (300, "fr", None), (300, "fr", None), (7, "en", docs[7][2])]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], DOCS)
    rows = audit(frame, spark.createDataFrame(labels, LABELS)).collect()
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in rows}
    assert len(rows) == len(got) and got == by_hand(docs, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit(spark.createDataFrame([], DOCS), none).count() == 0
    rows = audit(spark.createDataFrame([(1, None, None, None)], DOCS), none).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert all(r.good_lost == r.toxic_lost == 0 and r.kept + r.removed + r.redundant == 1 - (r.kept == 0 and r.removed == 0 and r.redundant == 0) for r in rows)


def test_other_filters_by_letter(spark):
    docs = spark.createDataFrame([(1, "en", "a b", None), (2, "en", "a", None)], DOCS)
    rows = audit(docs, spark.createDataFrame([], LABELS), filters={"A": "n_words < 2"}).collect()
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.shapley) for r in rows) == [
        ("AE", 1, 1, 1, 2), ("AE", 2, 1, 0, 0), ("EA", 1, 2, 0, 0), ("EA", 2, 1, 1, 2),
    ]


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    cursor = con.execute(filter_audit.ORACLE)
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, op11_filter_audit(spark, sf).select(columns).collect())) == sorted(cursor.fetchall())
