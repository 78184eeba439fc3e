import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkmill.llm import mixture, quality
from linkmill.llm.quality import best_cut
from tests.llm import test_decontaminate, test_exact_dups, test_near_dups, test_quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, sf):
    """A part of the small table with some rows of its own: copies, nulls, a benchmark passage."""
    path = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    base = docs.where(F.length("text") > 1500).orderBy("doc_id").first().text
    extra = [(9000, None), (9001, ""), (9002, base + "  "), (9003, base.replace(" ", "\n")), (9004, "some words before " + item), (None, "a row without id, as it is")]
    extra.append((9005, " ".join([*base.split(), "last"])))
    rows = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in extra], docs.schema)
    docs.unionByName(rows).repartition(4, "doc_id").write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def brute(docs, labels, items):
    """The stages by plain Python on lists; the mix is left to SQL."""
    scores = test_quality.brute([(r.doc_id, r.text) for r in docs], labels)
    known = dict(labels)
    chosen = [(s, known[r.doc_id] == 1) for r, s in zip(docs, scores, strict=True) if r.doc_id in known]
    import numpy as np

    cut = best_cut(np.array([s for s, _ in chosen]), np.array([g for _, g in chosen]))
    docs = [r for r, s in zip(docs, scores, strict=True) if s > cut]
    yield docs
    exact = test_exact_dups.brute([(r.doc_id, r.text) for r in docs])
    docs = [r for r in docs if (r.doc_id, r.doc_id) in {e[:2] for e in exact}]
    yield docs
    values = [test_near_dups.plain(r.text) for r in docs]
    top = 1 << 62
    parts = test_near_dups.brute_components([top if r.doc_id is None else r.doc_id for r in docs], values)
    docs = [r for r, c in zip(docs, parts, strict=True) if r.doc_id is None or r.doc_id == c]
    yield docs
    bad = {b[0] for b in test_decontaminate.brute([(r.doc_id, r.text) for r in docs], items) if b[5]}
    yield [r for r in docs if r.doc_id not in bad]


def test_every_stage_equals_brute_force(spark, folder, monkeypatch):
    monkeypatch.setattr(quality, "TEMPERATURE", 0.0)  # draws are then the weights, which brute force can order
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    want = brute(docs.collect(), labels, items)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == columns
        out.write.parquet(f"{folder}/stage{n}.parquet")
        docs = spark.read.parquet(f"{folder}/stage{n}.parquet")
        assert sorted(map(key, docs.collect())) == sorted(map(key, next(want)))
    con = duckdb.connect()
    con.execute(f"create view kept as select * from '{folder}/stage3.parquet/*.parquet'")
    mixed = sorted(con.execute(mixture.oracle("kept")).fetchall(), key=repr)
    assert sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()), key=repr) == mixed
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=repr) == mixed
    ids = {r.doc_id for r in docs.collect()}
    base = spark.read.parquet(f"{folder}/documents.parquet").where(F.length("text") > 1500).orderBy("doc_id").first().doc_id
    assert len(ids & {base, 9002, 9003, 9005}) == 1 and len(ids & {9000, 9001}) == 1 and 9004 not in ids and None in ids


def test_noise_moves_no_labelled_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, folder).collect()}
    assert sum((i in kept) == (q == 1) for i, q in labels.items()) >= 0.97 * len(labels)


def test_empty_documents(spark, folder, tmp_path):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_other_columns_are_carried_whatever_their_names(spark, folder):
    names = ["draw", "n_words", "item_ids", "_hits", "_key", "_others", "selected", "_file", "fp", "component_id", "a.b"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 40")
    extra = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    extra.write.parquet(f"{folder}/clash.parquet")
    extra = spark.read.parquet(f"{folder}/clash.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain = {r.doc_id for r in stage(spark, docs, folder).collect()}
        out = stage(spark, extra, folder)
        assert out.columns == extra.columns
        rows = out.collect()
        assert {r.doc_id for r in rows} == plain and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names)


def test_near_copies_are_told_apart_by_their_place(spark, tmp_path, sf):
    base = [[f"w{n}x{i}" for i in range(400)] for n in range(3)]
    near = [[" ".join(words[: 400 - cut]) for cut in range(4)] for words in base]
    assert all(test_near_dups.brute_components(range(4), list(map(test_near_dups.plain, texts))) == [0] * 4 for texts in near)
    rows = [(1, near[0][0]), (2, near[0][1]), (2, "clean row with the id of a near copy")]
    rows += [(3, text) for text in near[1]] + [(None, text) for text in near[2]] + [(None, "a row without id, as it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for given in (docs, spark.read.parquet(f"{tmp_path}/documents.parquet")):
        got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_near(spark, given, sf).collect()]
        kept = sorted((i or 0, "near" if t.startswith("w") else t) for i, t in got)
        assert kept == [(0, "a row without id, as it is"), (0, "near"), (1, "near"), (2, "clean row with the id of a near copy"), (3, "near")]
        assert set(got) <= set(rows)
