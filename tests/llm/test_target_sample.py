import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from linkmill.llm import slabs, target_sample
from linkmill.llm.target_sample import BUCKETS, bucket_counts, drawn, features, gains, op13_target_sample, resample

DOCS = "doc_id long, text string, score string"


def grams(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % BUCKETS


TEXTS = [None, "", "-", "a", "A b", "é É日本 x9\x7fy", "word " * 50, "x" * 64 + " " + "y" * 65 + " " + "z" * 3000, "end", "start ", " a,b", "🙂"]


@pytest.mark.parametrize("slab", [1, 9, 100, 1 << 19])
def test_features_equal_plain_loops_in_slabs_of_any_size(monkeypatch, slab):
    monkeypatch.setattr(slabs, "SLAB", slab)
    rng = random.Random(slab)
    texts = TEXTS + ["".join(rng.choice("aB1é -_日") for _ in range(rng.randrange(150))) for _ in range(80)]
    words, found = [0] * len(texts), [Counter() for _ in texts]
    for part in features(pa.array(texts)):
        for i, n in enumerate(part.words):
            words[part.first + i] += n
        for r, b in zip(part.row, part.bucket):
            found[part.first + r][b] += 1
    assert words == [len(grams(t)[0]) for t in texts]
    assert found == [Counter(map(bucket, grams(t)[1])) for t in texts]


def by_hand(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, f = grams(text)
        g = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000.0) / ((s[b] + 1.0) * (all_t + 10000.0)))) for b in map(bucket, f)]
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        rows.append([doc_id, len(words), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    ranked = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    k = percent * len(ranked) // 100
    return [[*r, None] for r in rows if r[1] < least] + [[*r, i + 1 if i < k else None] for i, r in enumerate(ranked)]


@pytest.mark.parametrize("percent", [0, 10, 25, 50, 99, 100])
def test_draw_equals_brute_force_with_nulls_ties_and_repeated_rows(spark, percent):
    rng = random.Random(percent)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma", "é9"]) + str(rng.randrange(30)) for _ in range(rng.choice([0, 5, 19, 20, 40])))) for i in range(60)]
    docs += [(100, docs[3][1] + " more" * 30)] * 9 + [(None, "null id " * 12)] * 5 + [(101, None), (None, None), (102, ""), (103, "x" * 5000)]
    target = ["alpha1 beta2 alpha3", None, ""]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], DOCS).repartition(3)
    got = resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent)
    want = by_hand(docs, target, percent)
    assert sorted(([r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]] for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_ties_of_all_columns_are_drawn_exactly(spark):
    rows = [(-5, 0, 1, i) for i in range(10)] + [(-5, 1, None, 20 + i) for i in range(10)] + [(-9, 0, 3, 40), (0, 0, 2, 41)]
    scores = spark.createDataFrame(rows, "_below long, _no_id int, doc_id long, _place long")
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3]))
    for k in range(1, len(rows) + 2):
        assert sorted(map(repr, map(tuple, scores.where(drawn(scores, k)).collect()))) == sorted(map(repr, order[:k]))
    assert drawn(scores, 0) is None


def test_very_long_text_and_counts(spark):
    text = " ".join(f"w{i % 999}" for i in range(600_000))
    docs = spark.createDataFrame([(1, text, None), (2, "W5 w6", None)], DOCS)
    want = np.bincount([bucket(f) for f in grams(text)[1] + grams("w5 w6")[1]], minlength=BUCKETS)
    assert (bucket_counts(docs) == want).all()
    rows = {r.doc_id: r for r in resample(docs, docs.select("text"), percent=100).collect()}
    assert rows[1].n_features == 2 * 600_000 - 1 and rows[1]["rank"] == 1 and rows[2]["rank"] is None
    assert (gains(want, want) == 0).all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert resample(empty, empty.select("text")).count() == 0
    rows = resample(spark.createDataFrame([(1, "a " * 30, None)], DOCS), empty.select("text"), percent=100).collect()
    assert [r["rank"] for r in rows] == [1]


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    cursor = con.execute(target_sample.ORACLE)
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, op13_target_sample(spark, sf).select(columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
