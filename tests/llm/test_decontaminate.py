import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from linkmill.llm import common, decontaminate
from linkmill.llm.decontaminate import find_contamination, kept_hashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(13, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        ids.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def made(seed):
    """Texts over few words, so that spans repeat, overlap, touch and stop one word short of a window."""
    rng = random.Random(seed)
    vocabulary = ["the", "Of", "éa", "über", "x1", "And", "日本", "to"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([13, 14, 20, 45])))) for i in range(12)]
    items += [(20, "short item, here"), (21, "one"), (22, ""), (23, None), (None, "null id item with a few words"), (20, "short item, here")]
    items += [(24, "same same same same same same same same same same same same same same same")]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            parts += rng.choices(vocabulary, k=rng.randrange(20))
            item = words(rng.choice(items)[1])
            a = rng.randrange(len(item) + 1)
            parts += item[a : a + rng.choice([3, 12, 13, 14, 50])]
        docs.append((i, "  ".join(parts)))
    docs += [(100, None), (101, ""), (102, "..."), (None, "one"), (103, "SAME\n" * 40), (104, "word " * 500 + items[0][1]), (100, None), (103, "SAME\n" * 40)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_and_sql(spark, tmp_path, seed):
    docs, items = made(seed)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(map(tuple, decontaminate.op10_decontaminate(spark, str(tmp_path)).collect()), key=repr)
    assert got == brute(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select distinct * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert {r for r in con.execute(decontaminate.ORACLE).fetchall() if r[0] is not None} == {r for r in got if r[0] is not None}


def test_very_long_text(spark):
    docs, items = [(1, "word " * 300_000 + "a b c d e f g h i j k l m " * 2 + "z")], [(5, "a b c d e f g h i j k l m"), (6, "z")]
    row = find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()[0]
    assert (row.n_words, row.n_hit, row.item_ids, row.contaminated) == (300_027, 27, ["5", "6"], False)
    assert [tuple(s) for s in row.hit_spans] == [(300_000, 300_026)]


def test_every_window_of_8_keeps_its_smallest(spark):
    rng = random.Random(5)
    values = [rng.randrange(50) for _ in range(200)]
    h = F.array(*map(F.lit, values)).cast("array<bigint>")
    row = spark.range(1).select(h.alias("h"), kept_hashes(h).alias("kept")).collect()[0]
    assert len(row.kept) == 195 and any(k is None for k in row.kept)
    assert all(any(k is not None for k in row.kept[i : i + 8]) for i in range(188))


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "n", 2)], "doc_id long, text string, n_hit string, item int")
    none = spark.createDataFrame([], "item_id long, text string")
    row = find_contamination(docs, none).collect()[0]
    assert (row.item, row.n_words, row.n_hit, row.item_ids, row.hit_spans, row.contaminated) == (2, 2, 0, [], [], False)
    assert find_contamination(docs.limit(0), none).count() == 0
    row = find_contamination(docs, spark.createDataFrame([(7, "b")], "item_id long, text string")).collect()[0]
    assert (row.n_hit, row.item_ids, row.contaminated) == (1, ["7"], True) and row.hit_spans[0] == (1, 1)


def test_repetitive_texts_equal_brute_force(spark):
    rng = random.Random(9)
    run = lambda n: ["a"] * n
    turns = lambda n: ["a", "b"] * n
    items = [(0, " ".join(run(150))), (1, " ".join(turns(40))), (2, "x " + " ".join(run(20)) + " y"), (3, " ".join(["a", "b", "c"] * 9)), (4, "a a a"), (5, "b a b a")]
    docs = []
    for i in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += rng.choice([run, turns, lambda n: ["a", "b", "c"] * n, lambda n: ["x", *run(n), "y"]])(rng.choice([1, 2, 5, 12, 13, 20, 60]))
            parts += rng.choice([[], ["z"], ["x"], ["y"]])
        docs.append((i, " ".join(parts)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for chosen in (items, items[:4]):
        found = find_contamination(frames[0], frames[1].where(F.col("item_id") < len(chosen))).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.contaminated) for r in found), key=repr)
        assert got == brute(docs, chosen)


def test_a_million_repeated_words_against_150_of_them(spark):
    docs = [(1, "a " * 1_000_000), (2, "a b " * 250_000), (3, "c " + "a " * 300_000 + "c")]
    items = [(7, "a " * 150), (8, "b a " * 75)]
    rows = find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {r.doc_id: (r.n_hit, r.item_ids, [tuple(s) for s in r.hit_spans]) for r in rows}
    assert got[1] == (1_000_000, ["7"], [(0, 999_999)]) and got[2] == (500_000, ["8"], [(0, 499_999)])
    assert got[3] == (300_000, ["7"], [(1, 300_000)])


def test_texts_without_hits_are_not_shuffled(spark, tmp_path):
    spark.createDataFrame([(i, f"clean text {i} " * 20) for i in range(200)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    sieved = common.sieved(docs, F.xxhash64("doc_id"), docs.where("doc_id < 5").select(F.xxhash64("doc_id").alias("key")))
    plan = sieved._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and sieved.where("_maybe").count() == 5
    assert find_contamination(docs, items).where("n_hit > 0").count() == 0
