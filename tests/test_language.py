import random

from pyspark.sql import functions as F

from linkmill.operators import language
from linkmill.operators.language import detect, fit, with_language

DOCS = "doc_id long, text string, lang string"


def made():
    rng = random.Random(2)
    words = {"aa": ["the", "and", "thing", "other", "ing"], "bb": ["der", "und", "sich", "über", "ung"], "cc": ["日本", "東京", "語る"]}
    text = lambda x, n: " ".join(rng.choice(words[x]) + rng.choice(["", "x"]) for _ in range(n))
    return [(i, text(x, rng.randrange(3, 30)), x) for i, x in enumerate(["aa", "bb", "cc"] * 30)]


def test_held_out_documents_and_edge_cases(spark, monkeypatch):
    rows = made()
    docs = spark.createDataFrame(rows, DOCS)
    profiles = fit(docs.where("doc_id < 45"))
    got = {r.doc_id: r.detected for r in detect(docs, profiles, "doc_id").collect()}
    assert got == {i: x for i, _, x in rows}
    odd = spark.createDataFrame([(1, None, None), (2, "", None), (3, "12 ?!", None), (4, "THE und der", "zz"), (5, "the " * 300_000, None)], DOCS)
    assert {r.doc_id: r.detected for r in detect(odd, profiles, "doc_id").collect()} == {1: None, 2: None, 3: None, 4: "bb", 5: "aa"}
    assert {r.doc_id: r.lang for r in with_language(odd, profiles, "doc_id").collect()} == {1: None, 2: None, 3: None, 4: "zz", 5: "aa"}
    none = fit(docs.limit(0))
    assert [r.detected for r in detect(odd.limit(2), none, "doc_id").collect()] == [None, None] and detect(docs.limit(0), profiles, "doc_id").count() == 0
    monkeypatch.setattr(language, "LANGUAGES", 2)
    assert len(fit(docs).langs) == 2


def test_given_languages_are_found_from_half_of_the_sources(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    half = F.substring("source", 4, 10).cast("int") < 10
    held = docs.where(~half & (F.length("text") > 200))
    right = detect(held, fit(docs.where(half)), "doc_id").join(held, "doc_id").where("detected = lang").count()
    assert right >= 0.97 * held.count()
    plan = detect(held, fit(docs.where(half)), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
