import hashlib
import math
import random
import re

import numpy as np
import pytest

from linkmill.llm import slabs
from linkmill.llm.sanitise import KINDS, NEAR, base_spans, contexts, find_personal_data, op12_sanitise, sanitise, sketch, term_frequencies, terms_of

DOCS = "doc_id long, text string, base string"


def plain_base(text):
    """The contract's patterns as they stand."""
    found = []
    for kind, pattern in enumerate(
        [
            r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]",
        ]
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            checked = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            good = [True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and checked, 10 <= len(digits) <= 15][kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


CASES = [
    "", "a@b", "a@b.c", "x a@b@c.d y", "a@b.c-d@e.f", "a@b.c_d@e.f.", "@b.c", "a@.b", "a@@b.c", "é.a@b.c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.255",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111  1111 1111 1111", "4111111111111112", "9" * 30, "+1 (017) 555-7713.", "+12345678901234567", "++1 234 567 890 12 ",
    "+1-2 3", "call +44 20 7946 0958 or a.b@c.de, 10.0.0.1", "日本 a@b.cd 日本 +1 (017) 555-7713", "1.2.3.4@5.6.7.8", "+4111 1111 1111 1111", "٣.٣.٣.٣ ４１１",
]


def test_base_spans_are_the_patterns_own():
    rng = random.Random(1)
    for text in CASES + ["".join(rng.choice("a1.@+- (2)é4") for _ in range(60)) for _ in range(3000)]:
        assert [s[:3] for s in base_spans(text)] == plain_base(text), text


def test_card_numbers_of_all_lengths():
    rng = random.Random(2)
    texts = [rng.choice(["", " ", "-"]).join(str(rng.randrange(10)) for _ in range(rng.randrange(12, 22))) for _ in range(3000)]
    assert all([s[:3] for s in base_spans(t)] == plain_base(t) for t in texts)
    assert sum(bool(plain_base(t)) for t in texts) > 100


@pytest.mark.parametrize("text", ["a" * 1_000_000, "a@" * 500_000, "1" * 1_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "1 " * 500_000, "+1" * 500_000, "a@b" * 300_000 + ".c"])
def test_long_runs_take_linear_time(text):
    assert all(len(s) == 4 for s in base_spans(text))


@pytest.mark.parametrize("slab", [3, 1 << 19])
def test_terms_in_code_points(monkeypatch, slab):
    monkeypatch.setattr(slabs, "SLAB", slab)
    text = "Ünd é9 x-y 日本語 Ab AB"
    start, end, key = terms_of(np.frombuffer(text.encode(), np.uint8))
    assert [text[s:e] for s, e in zip(start, end)] == ["Ünd", "é9", "x", "y", "日本語", "Ab", "AB"]
    assert len(set(key)) == 6 and key[-1] == key[-2]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def near(text):
    """(entity, term, start, end) by loops."""
    spans = base_spans(text)
    free = [w for w in words_of(text) if not any(s < w[1] and w[0] < e for s, _, e, _ in spans)]
    found = set()
    for s, k, e, v in spans:
        before, after = [w for w in free if w[0] < s], [w for w in free if w[0] >= e]
        for w in before[-NEAR:] + after[:NEAR]:
            found.add((f"{KINDS[k]}:{v}", w[2], w[0], w[1]))
    return found


def test_contexts_equal_loops():
    rng = random.Random(3)
    for _ in range(100):
        words = [rng.choice(["Ann", "é", "x1", "the", "a@b.cd", "10.0.0.1", "+1 (017) 555-7713", "4111 1111 1111 1111"]) for _ in range(rng.randrange(1, 60))]
        text = rng.choice([" ", ", ", "\n"]).join(words)
        spans = base_spans(text)
        if not spans:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        entities, rows, _ = contexts(raw, spans)
        hashed = {w: k for (s, e, k) in zip(*terms_of(raw)) for w in [text[s:e].lower() if text[s:e].isascii() else text[s:e]]}
        want = {(entities.index(e), int(hashed[t].view(np.int64)), s, x) for e, t, s, x in near(text)}
        assert {(int(r[0]), int(r[1]), int(r[3]), int(r[4])) for r in rows.T} == want
        assert rows[2].sum() == len({(r[0], r[1]) for r in rows.T})


def by_hand(docs):
    """(base, terms) of each document, with all counting done by loops over the whole corpus."""
    texts = [t or "" for _, t in docs]
    terms = [set(w[2] for w in words_of(t)) for t in texts]
    nearby = [near(t) for t in texts]
    holds = [{f"{KINDS[k]}:{v}" for _, k, _, v in base_spans(t)} for t in texts]
    copy = [sketch(terms_of(np.frombuffer(t.encode(), np.uint8))[2]) if h else None for t, h in zip(texts, holds)]
    out = []
    for i, text in enumerate(texts):
        marked = {}
        for e, t, s, x in nearby[i]:
            both = [j for j in range(len(texts)) if any(n[:2] == (e, t) for n in nearby[j])]
            with_e, with_t = sum(e in h for h in holds), sum(t in w for w in terms)
            copies = len({copy[j] for j in both})
            information = math.log(len(texts) / with_e)
            share = math.log(len(texts) * len(both) / (with_e * with_t)) / information if information > 0 else 0
            if copies >= 3 and 2 * copies >= len(both) and share >= 0.6:
                marked[s, x] = max(share, marked.get((s, x), 0))
        out.append(([s[:3] for s in base_spans(text)], sorted((s, x, round(v, 9)) for (s, x), v in marked.items())))
    return out


def corpus():
    rng = random.Random(4)
    filler = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(40)}" for _ in range(n))
    docs = [(i, filler(30)) for i in range(60)]
    docs += [(100 + i, f"{filler(12)} Jane Quillington ({filler(1)}) jq@corp.example {filler(12)}") for i in range(5)]
    docs += [(200 + i, f"{filler(12)} Bob +1 (017) 555-7713 {filler(12)}") for i in range(4)] + [(210 + i, f"Bob {filler(9)}") for i in range(3)]
    docs += [(300 + i, "zanzibar copy of one text with q@copy.example unusual words") for i in range(6)]
    docs += [(None, None), (None, ""), (400, "a@b.cd"), (400, "a@b.cd"), (401, "Quillington alone")]
    return docs


def test_terms_equal_brute_force_with_nulls_ties_and_copies(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "clash") for d in docs], DOCS).repartition(3)
    key = lambda d: (d[0] is None, d[0] or 0, d[1] is not None, d[1] or "")
    rows = find_personal_data(frame).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, [tuple(s) for s in r.base], [(t.start, t.end, round(t.share, 9)) for t in r.terms]) for r in rows)
    want = sorted((d[0] is None, d[0] or 0, *found) for d, found in zip(docs, by_hand(docs)))
    assert sorted(docs, key=key) and got == want
    words = {d[1][s:e] for d, (_, terms) in zip(docs, by_hand(docs)) for s, e, _ in terms}
    assert {"Jane", "Quillington", "Bob"} <= words and "zanzibar" not in words


def test_sanitised_texts(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "clash") for d in docs], DOCS)
    rows = sanitise(frame).collect()
    assert len(rows) == len(docs) and set(rows[0].asDict()) == {"doc_id", "text", "base", "sanitised"}
    for r in rows:
        assert (r.sanitised is None) == (r.text is None)
        assert "jq@corp" not in (r.sanitised or "") and "555" not in (r.sanitised or "")
        if r.doc_id is not None and r.doc_id < 100:
            assert r.sanitised == r.text
        if r.doc_id is not None and 100 <= r.doc_id < 105:
            assert "Jane" not in r.sanitised and "<EMAIL>" in r.sanitised and "Quillington" not in r.sanitised
        if r.doc_id is not None and 200 <= r.doc_id < 204:
            assert "<PHONE>" in r.sanitised and ("<NAME>" in r.sanitised or "Bob" not in r.sanitised)
        if r.doc_id == 401:
            assert r.sanitised == r.text


def test_frequencies_count_rows(spark):
    texts = spark.createDataFrame([("a b a",), ("A",), (None,), ("",), ("b " * 300_000,)], "text string")
    key = terms_of(np.frombuffer(b"a b zz", np.uint8))[2].view(np.int64)
    wanted = spark.createDataFrame([(int(k),) for k in key], "term long")
    assert {r.term: r.n_docs for r in term_frequencies(texts, wanted).collect()} == {int(key[0]): 2, int(key[1]): 2}
    assert term_frequencies(texts, wanted.limit(0)).count() == 0


def test_empty_table_and_very_long_text(spark):
    assert find_personal_data(spark.createDataFrame([], DOCS)).count() == 0
    text = "word " * 400_000 + "a@b.cd " + "x" * 500_000
    row = find_personal_data(spark.createDataFrame([(1, text, None)], DOCS)).first()
    assert [tuple(s) for s in row.base] == [(2_000_000, 0, 2_000_006)] and row.terms == []


def test_query_equals_the_patterns_on_the_whole_table(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op12_sanitise(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        said = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert [x for x in r.spans.split(",") if not x.startswith("term")] == said.split(",")
