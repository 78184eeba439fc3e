import functools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkmill.functions import text as X
from linkmill.operators import dedup
from linkmill.operators.lsh_index import ClusteredIndex
from linkmill.plans.corpus import near_dedup
from linkmill.streaming.dedup import dedup_batch

BANDED = "doc long, bands array<string>"


def replay(rows, used=None):
    """Documents one after the other, as a plain loop."""
    used, kept = set(used or ()), []
    for doc, bands in sorted(rows):
        keys = set(enumerate(bands))
        if not keys & used:
            used |= keys
            kept.append(doc)
    return kept


def kept_of(spark, rows, **options):
    df = spark.createDataFrame(rows, BANDED).repartition(3)
    return sorted(r.doc for r in dedup.greedy_keep(df, "doc", **options).collect())


def random_cases(seed, n_cases=150, n_docs=12):
    """Many small independent cases in one table: the case number is part of every key."""
    pick, rows = random.Random(seed), []
    for case in range(n_cases):
        width = pick.choice([2, 3, 5, 9])
        order = pick.sample(range(n_docs), n_docs)
        rows += [
            (case * n_docs + order[i], [f"{case}-{pick.randrange(width)}" for _ in range(3)]) for i in range(n_docs)
        ]
    return rows


@pytest.mark.parametrize("hot_rows", [200_000, 3])
def test_rounds_equal_replay(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(dedup, "MAX_HOT_BUCKETS", 10**9)
    rows = random_cases(hot_rows)
    assert kept_of(spark, rows, hot_rows=hot_rows) == replay(rows)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=3, max_size=3), min_size=1, max_size=60))
def test_rounds_equal_replay_on_dense_graphs(spark, bands):
    rows = [(i, [str(b) for b in keys]) for i, keys in enumerate(bands)]
    assert kept_of(spark, rows) == replay(rows)


def test_it_is_greedy_not_components(spark):
    # 1~2 and 2~3, but not 1~3: the first and the last stay.
    assert kept_of(spark, [(1, ["a", "p", "x"]), (2, ["a", "q", "y"]), (3, ["b", "q", "z"])]) == [1, 3]
    # The same chain in another order: the middle one comes first and takes both.
    assert kept_of(spark, [(2, ["a", "p", "x"]), (1, ["a", "q", "y"]), (3, ["b", "q", "z"])]) == [1]


def test_bands_are_told_apart(spark):
    assert kept_of(spark, [(1, ["a", "b"]), (2, ["b", "a"])]) == [1, 2]


def test_long_chain_and_one_huge_group(spark):
    chain = [(i, [f"c{i}", f"c{i + 1}"]) if i % 2 else (i, [f"c{i + 1}", f"c{i}"]) for i in range(14)]
    chain = [(i, [f"l{(i + 1) // 2}", f"r{i // 2}"]) for i in range(14)]
    copies = [(100 + i, ["same", "copy"]) for i in range(3000)]
    near = [(5000 + i, ["same", f"other{i}"]) for i in range(3000)]
    rows = chain + copies + near
    assert kept_of(spark, rows, hot_rows=500) == replay(rows)


def test_nothing_and_one_document(spark):
    assert kept_of(spark, [(1, ["a", "b"])]) == [1]
    empty = spark.createDataFrame([], BANDED)
    assert dedup.greedy_keep(empty, "doc").count() == 0


def test_addresses_as_order(spark):
    rows = [(("f1", 0), ["a", "x"]), (("f1", 1), ["a", "y"]), (("f2", 0), ["b", "y"]), (("f0", 9), ["b", "z"])]
    df = spark.createDataFrame(rows, "address struct<file: string, doc_ord: long>, bands array<string>")
    kept = sorted(tuple(r.address) for r in dedup.greedy_keep(df, "address").collect())
    # In order: f0/9 stays, f1/0 stays, f1/1 shares with f1/0, f2/0 shares with f0/9.
    assert kept == [("f0", 9), ("f1", 0)]


def test_candidates_are_linear_in_a_huge_bucket(spark):
    banded = spark.createDataFrame([(i, ["same", f"x{i}"]) for i in range(500)], BANDED)
    index = dedup.index_rows(banded, banded.where("doc = 0").select("doc"), "doc")
    pairs = dedup.lsh_candidates(banded, index, "doc", hot_rows=10).collect()
    assert sorted((r.doc, r.found) for r in pairs) == [(i, 0) for i in range(1, 500)]


def test_incremental_equals_replay(spark):
    rows = [(d, b) for d, b in random_cases(5, n_cases=40)]
    half = len(rows) // 2
    index = spark.createDataFrame([], "band int, band_key string, doc long")
    kept = set()
    for batch in (rows[:half], rows[half:], rows[:half]):
        df = spark.createDataFrame(batch, BANDED)
        survivors, new = dedup.incremental_dedup(df, index, "doc")
        kept |= {r.doc for r in survivors.collect()}
        index = index.unionByName(new)
    first = replay(rows[:half])
    used = {key for d, bands in rows[:half] if d in first for key in enumerate(bands)}
    assert sorted(kept) == sorted(first + replay(rows[half:], used))
    assert index.count() == index.select("band", "band_key").distinct().count()


def texts(rng, n):
    return [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 6, 7]))) for _ in range(n)]


def files(path):
    """Data files below a folder with their contents' sizes; Spark gives every write new names."""
    return sorted((str(f.parent.relative_to(path)), f.name.split("_")[-1], f.stat().st_size) for f in path.rglob("part-*.parquet"))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    docs = spark.createDataFrame(
        [(0, "one two three four five six"), (1, "one two three four five six"), (2, "x"), (3, "y"), (4, "a b c d e f g")],
        "doc_id long, text string",
    )
    index, dropped = ClusteredIndex(str(tmp_path / "index"), "doc_id", "bigint", buckets=4), str(tmp_path / "dropped")
    state = []
    for _ in range(2):
        dedup_batch(docs, "doc_id", index, dropped, 7)
        lost = sorted(r.doc_id for r in spark.read.parquet(dropped).collect())
        state.append((sorted(map(tuple, index.before(spark, 8).collect())), lost, files(tmp_path / "index")))
    assert state[0] == state[1] and state[0][1] == [1, 3]


def test_batches_with_compaction_equal_replay(spark, tmp_path):
    rng = random.Random(11)
    index = ClusteredIndex(str(tmp_path / "index"), "doc_id", "bigint", buckets=3, compact_every=2)
    rows, dropped = [(i, t) for i, t in enumerate(texts(rng, 60))], str(tmp_path / "dropped")
    for n in range(6):
        batch = spark.createDataFrame(rows[10 * n : 10 * n + 10] + ([] if n < 3 else rows[:2]), "doc_id long, text string")
        dedup_batch(batch, "doc_id", index, dropped, n)
        if n in (2, 5):  # the first batch of a generation and the last one
            before = files(tmp_path / "index")
            dedup_batch(batch, "doc_id", index, dropped, n)
            assert files(tmp_path / "index") == before
    banded = X.with_bands(X.with_signature(spark.createDataFrame(rows, "doc_id long, text string"))).orderBy("doc_id")
    bands = {r.doc_id: r.bands for r in banded.collect()}
    kept = replay(sorted(bands.items()))
    assert sorted(map(tuple, index.before(spark, 6).collect())) == sorted((b, k, d) for d in kept for b, k in enumerate(bands[d]))
    # Two generations exist, and the compacted one has one file a bucket at most.
    assert sorted(p.name for p in (tmp_path / "index").iterdir()) == ["side=0", "side=1"]
    assert len(list((tmp_path / "index" / "side=0" / "batch_id=-2").glob("part-*.parquet"))) <= 3
    assert not (tmp_path / "index" / "side=0" / "batch_id=0").exists()
    # Another application knows no tables and finds the same index in its folder.
    want = sorted(map(tuple, index.before(spark, 6).collect()))
    for known in spark.catalog.listTables():
        if known.name.startswith("linkmill_lsh_"):
            spark.sql(f"drop table {known.name}")
    assert sorted(map(tuple, index.before(spark, 6).collect())) == want


def test_index_is_not_shuffled_and_read_once(spark, tmp_path, monkeypatch):
    index = ClusteredIndex(str(tmp_path / "index"), "doc_id", "struct<file:string,at:bigint>", buckets=5)
    key = F.struct(F.lit("f").alias("file"), F.col("id").alias("at")).alias("doc_id")
    banded = spark.range(40).select(key, F.array(F.col("id").cast("string"), F.col("id").cast("string")).alias("bands"))
    index.add(dedup.band_rows(banded, "doc_id"), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        batch = spark.range(30, 50).select(key, F.array(F.col("id").cast("string"), F.lit("x")).alias("bands"))
        hits = dedup._bucket_hits(batch, index.before(spark, 1), "doc_id", n_edges=40)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.found.at for r in hits.collect()) == list(range(30, 40))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "SelectedBucketsCount: 5 out of 5" in line)
    above, depth = [], lines[at].index("+-")
    for line in reversed(lines[:at]):  # from the scan up to the join that it feeds
        here = max(line.find("+-"), line.find(":-"))
        if here < depth:
            depth = here
            above.append(line)
        if above and "Join" in above[-1]:
            break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    assert plan.count("FileScan") == 1


def test_short_documents(spark):
    docs = spark.createDataFrame([(0, "a b"), (1, ""), (2, "c d e f"), (3, "long enough to be one gram")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup(docs, "doc_id")[0].collect()) == [0, 3]
    assert sorted(r.doc_id for r in near_dedup(docs, "doc_id", short_docs="keep")[0].collect()) == [0, 1, 2, 3]


def plain_signature(text):
    toks = [zlib.crc32(t.encode()) % X.PRIME for t in re.findall(r"\w+|[^\w\s]", text)]
    hashes = [functools.reduce(lambda h, t: (h * X.HASH_BASE + t) % X.PRIME, toks[i : i + 5], 0) for i in range(len(toks) - 4)]
    perms = [X.permutation(k) for k in range(X.NUM_PERM)]
    return [min(((h * a % X.PRIME + b) % X.PRIME for h in hashes), default=X.PRIME) for a, b in perms]


def test_signatures_use_as_many_tasks_as_asked_for(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "i int, text string").coalesce(1)
    assert X.with_signature(df, tasks=3).rdd.getNumPartitions() == 3
    assert X.with_signature(df).rdd.getNumPartitions() == 1


def test_signatures_against_a_loop(spark):
    texts = ["", "one two", "a b c d e", "Ünïcode, is it — all right? yes yes yes yes yes yes", "word " * 300, "x_1 y. z! 4 5 6"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = X.with_bands(X.with_signature(df)).orderBy("i").collect()
    assert [r.sig for r in rows] == [plain_signature(t) for t in texts]
    assert rows[3].bands == ["-".join(map(str, rows[3].sig[b : b + 3])) for b in (0, 3, 6)]


def test_shingles_are_distinct(spark):
    df = spark.createDataFrame([("a b c d e a b c d e",), ("a b",)], "text string")
    first, second = X.with_shingles(df).collect()
    assert sorted(first.shingles) == ["a b c d e", "b c d e a", "c d e a b", "d e a b c", "e a b c d"]
    assert second.shingles == []


def test_band_shape():
    assert X.band_shape(0.5, 10) == (3, 3)
    assert X.band_shape(0.9, 10)[1] > X.band_shape(0.2, 10)[1]


def test_duplicate_lists(spark):
    docs = spark.createDataFrame([("f", 0), ("f", 1), ("g", 0)], "source_file string, doc_ord long")
    lists = [docs.where("doc_ord = 1"), docs.where("source_file = 'f' and doc_ord = 1")]
    dropped = dedup.union_duplicates(*lists)
    assert dropped.count() == 1
    left = dedup.apply_duplicates(docs, dropped, ["source_file", "doc_ord"])
    assert sorted(map(tuple, left.collect())) == [("f", 0), ("g", 0)]


def test_plan_has_no_cross_join_and_no_python(spark):
    banded = spark.createDataFrame([(1, ["a", "b"])], BANDED)
    facts = spark.createDataFrame([(0, "a", 1)], "band int, band_key string, n long")
    df = dedup.spread_bucket_facts(dedup.band_rows(banded, "doc"), facts, 2).groupBy("doc").agg(F.max("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_minima_against_a_loop_however_texts_are_cut(monkeypatch):
    rng = np.random.default_rng(11)
    sizes = [0, 1, 4, 5, 6, 0, 0, 40, 3, 5, 131, 2, 0]
    texts = [rng.integers(0, X.PRIME, n) for n in sizes]
    texts[4][:] = X.PRIME - 1
    offsets, tokens = np.cumsum([0, *sizes]), np.concatenate(texts)

    def plain(one, k):
        a, b = X.permutation(k)
        runs = [one[i : i + X.NGRAM].tolist() for i in range(len(one) - X.NGRAM + 1)]
        hashes = [sum(d * X.HASH_BASE ** (X.NGRAM - 1 - j) for j, d in enumerate(run)) % X.PRIME for run in runs]
        return min([(h * a + b) % X.PRIME for h in hashes], default=X.PRIME)

    want = [[plain(one, k) for k in range(X.NUM_PERM)] for one in texts]
    for slab in (1 << 16, 7, 1):
        monkeypatch.setattr(X, "SLAB", slab)
        assert X.minima(tokens, offsets, X.NUM_PERM).tolist() == want
    assert X.minima(tokens, offsets[4:9], X.NUM_PERM).tolist() == want[4:8]
    assert X.minima(tokens[:0], np.array([0]), X.NUM_PERM).shape == (0, X.NUM_PERM)


def test_signatures_evaluate_no_expression_for_every_ngram(spark):
    df = spark.createDataFrame([(0, "a b c d e f g"), (1, None)], "i long, text string")
    signed = X.with_bands(X.with_signature(df))
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("ArrowEvalPython") == 1 and "array_min" not in plan
    assert signed.where("i = 1").first().sig == [X.PRIME] * X.NUM_PERM
