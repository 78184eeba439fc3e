import math

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from linkmill.llm import hashing, quality
from linkmill.llm.quality import best_cut, kth_largest, op6_quality, resampler


def test_tokens_and_hashes_don_t_depend_on_their_place(monkeypatch):
    texts = ["The cat,, the CAT  caté", "", " ", "x " * 50, "the", "é" * 30]
    flat = {}
    for first, n, tokens, row in hashing.batches(texts):
        for h, r, a, b in zip(tokens.hashes(), row, tokens.start, tokens.end, strict=True):
            flat.setdefault(first + r, []).append(int(h))
    assert flat[0][0] == flat[0][3] == flat[4][0] and flat[0][1] != flat[0][0] and 1 not in flat and 2 not in flat
    assert len(set(flat[3])) == 1 and len(flat[3]) == 50 and len(flat[5]) == 1
    monkeypatch.setattr(hashing, "SLAB", 16)
    again = {}
    for first, n, tokens, row in hashing.batches(texts):
        for h, r in zip(tokens.hashes(), row, strict=True):
            again.setdefault(first + r, []).append(int(h))
    assert again == flat


def test_ngrams_run_over_the_parts_of_a_long_text(monkeypatch):
    text = "a b c c c d, e " * 40
    whole = np.concatenate([g for _, _, g, _ in quality.ngrams(["z", text])])
    monkeypatch.setattr(hashing, "SLAB", 32)
    parts = np.concatenate([g for _, _, g, _ in quality.ngrams(["z", text])])
    assert sorted(whole) == sorted(parts)


def test_kth_largest_equals_sorting(spark):
    values = [float(v) for v in np.random.default_rng(1).normal(size=300)] + [2.0] * 40
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 17, 60, 340):
        assert kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(rows, "v", 0) is None and kth_largest(rows.limit(0), "v", 3) is None


def test_best_cut():
    assert best_cut(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 2.5
    assert best_cut(np.array([1.0, 2]), np.array([True, True])) == -math.inf
    assert best_cut(np.array([]), np.array([], bool)) == -math.inf


def brute(rows, labels):
    """Plain counting of the same n-grams, with dictionaries."""
    good = {i for i, q in labels if q == 1 and i is not None}
    raw, target, docs = {}, {}, []
    for i, text in rows:
        grams = [int(g) for _, _, gs, _ in quality.ngrams([text or ""]) for g in gs]
        docs.append(grams)
        for g in grams:
            raw[g] = raw.get(g, 1) + 1
            if i in good:
                target[g] = target.get(g, 1) + 1
    t = sum(target.values()) + quality.BUCKETS - len(target)
    r = sum(raw.values()) + quality.BUCKETS - len(raw)
    return [sum(math.log(target.get(g, 1) / t) - math.log(raw.get(g, 1) / r) for g in grams) for grams in docs]


def test_weights_selection_and_edge_cases(spark):
    rows = [(i, f"plain words number {i % 9} of good text, as it is.") for i in range(60)]
    rows += [(100 + i, "junk*** ### %%% words### " * (1 + i % 3)) for i in range(20)] + [(200, None), (201, ""), (0, rows[0][1]), (None, "plain words")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(15)] + [(None, 1), (50, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, draw string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    scores, mark = resampler(docs, marks)
    got = mark(docs).collect()
    assert len(got) == len(rows) and [abs(a.log_weight - b) < 1e-6 for a, b in zip(got, brute(rows, labels), strict=True)] == [True] * len(rows)
    assert {r.doc_id for r in got if not r.selected} == set(range(100, 120))
    assert sorted((r.id or 0, r.selected) for r in scores.collect()) == sorted((r.doc_id or 0, r.selected) for r in got)
    assert resampler(docs.limit(0), marks)[0].count() == 0
    assert all(r.selected for r in resampler(docs, marks.limit(0))[0].collect())


def test_labelled_documents_of_the_whole_table(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r.selected for r in op6_quality(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    right = [got[i] == (q == 1) for i, q in labels.items()]
    assert sum(right) >= 0.97 * len(right)
    assert op6_quality(spark, sf).where(F.col("draw").isNull()).count() == 0


def test_short_clean_and_empty_texts_stay_where_most_is_junk(spark, monkeypatch):
    monkeypatch.setattr(quality, "TEMPERATURE", 0.0)
    good = [(i, "plain words of good text, as it is. " * 40) for i in range(10)] + [(20, "good text"), (21, "plain words")]
    empty = [(30, None), (31, ""), (32, " \n")]
    junk = [(100 + i, "junk*** ### %%% " * (1 if i < 60 else 300)) for i in range(90)]
    docs = spark.createDataFrame(good + empty + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(8)] + [(100 + i, 0) for i in range(60)], "doc_id long, quality int")
    weights = brute(good + junk, [(i, 1) for i in range(8)])
    assert max(weights[12:72]) < 0 < min(weights[:12]) and max(weights[10:12]) < (max(weights[12:72]) + min(weights[:8])) / 2
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, "").collect()}
    assert kept == {i for i, _ in good + empty}


def test_best_cut_is_0_where_that_parts_as_well():
    assert best_cut(np.array([-4.0, 10]), np.array([False, True])) == 0
    assert best_cut(np.array([-10.0, 4]), np.array([False, True])) == -3
    assert best_cut(np.array([2.0, 4]), np.array([False, True])) == 3


def test_a_labelled_id_that_comes_very_often_counts_once(spark, monkeypatch):
    collected = []
    monkeypatch.setattr(quality, "best_cut", lambda scores, good: collected.append(len(scores)) or best_cut(scores, good))
    rows = [(1, "plain words of good text"), (2, "junk*** ### %%%")] * 5000 + [(3, "plain words"), (4, "### junk***")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    scores, _ = resampler(docs, labels)
    assert collected == [4] and scores.count() == len(rows)


def test_a_share_is_drawn_and_the_noise_decides_as_far_as_it_is_let(spark):
    rows = [(i, f"plain words number {i % 9} of good text") for i in range(100)] + [(100 + i, "junk*** ### %%%") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")

    def drawn(seed, temperature):
        scores, _ = resampler(docs, labels, seed=seed, share=0.25, temperature=temperature)
        return {r.id for r in scores.where("selected").collect()}

    cold, hot = [drawn(seed, 0.01) for seed in (1, 2)], [drawn(seed, 1e6) for seed in (1, 2)]
    assert all(len(d) == 50 for d in cold + hot)
    # Without noise the target's own texts are drawn; with much of it every document alike, and another seed draws others.
    assert all(i < 100 for d in cold for i in d)
    assert all(10 <= sum(i < 100 for i in d) <= 40 for d in hot) and len(hot[0] - hot[1]) > 20
    assert resampler(docs, labels, share=0.0)[0].where("selected").count() == 0
