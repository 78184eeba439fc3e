import json
import types

import pytest
from pyspark.sql import functions as F

from linkmill import session
from linkmill.operators.documents import in_languages, min_tokens
from linkmill.operators.stats import corpus_stats, duplicate_stats, release_table
from linkmill.plans.corpus import clean_corpus, documents_from_pages, url_records_from_posts
from linkmill.sources.documents import read_documents
from linkmill.sources.dumps import parse_posts
from linkmill.sources.releases import first_submitted, write_release

LONG = "one two three four five six seven eight nine ten"


def page(text):
    return f'<html lang="en"><title>T</title><article><p>{text}</p></article></html>'


@pytest.fixture(scope="module")
def documents(spark):
    def post(n, url, score, **more):
        made = {"id": f"{n}", "is_self": False, "url": url, "score": score, "title": f"t{n}", "created_utc": 1136073600 + n * 86400}
        return (json.dumps({**made, **more}),)

    posts = [
        post(1, "https://a.com/1", 2),
        post(2, "https://a.com/1", 1),
        post(2, "https://a.com/1", 9),
        post(3, "https://b.com/2", 2),
        post(4, "https://c.com/3", 50),
        post(5, "https://d.com/4", 5, is_self=True),
        post(6, "https://imgur.com/5", 99),
        post(40, "https://e.com/6", 3),
        post(7, "https://gone.com/7", 7),
    ]
    pages = [
        ("https://a.com/1", page(LONG)),
        ("https://b.com/2", page("below the score " + LONG)),
        ("https://c.com/3", page(LONG)),
        ("https://d.com/4", page("never linked " + LONG)),
        ("https://imgur.com/5", page("an image " + LONG)),
        ("https://e.com/6", page("different words here and not the same at all")),
    ]
    records = url_records_from_posts(parse_posts(spark.createDataFrame(posts, "value string")))
    return documents_from_pages(records, spark.createDataFrame(pages, "url string, html string"))


def test_dumps_to_clean_corpus(documents):
    rows = {r.url: r for r in documents.collect()}
    assert set(rows) == {"https://a.com/1", "https://c.com/3", "https://e.com/6"}
    first = rows["https://a.com/1"]
    # Of the two copies of id 2 the smaller one counts, so the total is just enough.
    assert (first.meta.reddit_id, first.meta.reddit_score, first.total_score) == ([1, 2], [2, 1], 3)
    assert (first.meta.title, first.meta.domain, first.meta.word_count) == ("T", "a.com", 10)
    result = clean_corpus(documents, "url")
    assert sorted(r.url for r in result.clean.collect()) == ["https://a.com/1", "https://e.com/6"]
    assert [r.url for r in result.dropped.collect()] == ["https://c.com/3"]
    strict = clean_corpus(documents, "url", min_score=4)
    assert [r.url for r in strict.clean.collect()] == ["https://c.com/3"]


def test_releases(spark, documents, tmp_path):
    write_release(documents, str(tmp_path / "jsonl"), file_format="jsonl")
    back = read_documents(spark, str(tmp_path / "jsonl"))
    assert back.count() == 3 and all("reddit_created_utc" in json.loads(r.meta) for r in back.collect())
    write_release(first_submitted(documents), str(tmp_path / "months"), month_of="created")
    assert sorted(p.name for p in (tmp_path / "months").glob("month=*")) == ["month=2006-01", "month=2006-02"]
    assert spark.read.parquet(str(tmp_path / "months")).count() == 3


def test_statistics(spark):
    docs = spark.createDataFrame([("é" * 3,), ("ab",)], "text string")
    assert tuple(corpus_stats(docs).first()) == (2, 5, 8, 0.0)
    assert tuple(corpus_stats(docs.limit(0)).first())[:3] == (0, 0, 0)
    counted = docs.agg(F.count("*").alias("n_docs"))
    assert tuple(duplicate_stats(counted, docs.limit(1)).first()) == (2, 1, 50.0)
    assert duplicate_stats(docs.limit(0).agg(F.count("*").alias("n_docs")), docs.limit(0)).first().useful_pct is None
    table = {r.release: r for r in release_table({"raw": docs, "clean": docs.where("text = 'ab'")}).collect()}
    assert (table["clean"].docs_pct, table["clean"].chars_pct, table["raw"].docs_pct) == (50.0, 40.0, 100.0)


def test_optional_filters(spark):
    docs = spark.createDataFrame([("a, b c", ("en",)), ("a", ("fr",))], "text string, meta struct<lang: string>")
    assert [r.text for r in in_languages(docs, ["fr"]).collect()] == ["a"]
    assert [r.text for r in min_tokens(docs, 4).collect()] == ["a, b c"]


def test_scratch_folder_is_shared(spark):
    fake = lambda master, folder: types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda *_: folder),
        sparkContext=types.SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )
    assert session.scratch_root(fake("spark://head:7077", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError):
        session.scratch_root(fake("spark://head:7077", None))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
