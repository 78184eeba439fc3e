import datetime

from pyspark.sql import functions as F

from linkmill.operators.documents import attach_url_meta, min_total_score, with_text
from linkmill.operators.submissions import conform
from linkmill.operators.url_records import build_url_records, merge_url_records, url_totals
from linkmill.sources import url_files

T0 = datetime.datetime(2010, 1, 1)
DDL = "id long, url string, score long, title string, subreddit string, created_utc timestamp_ntz"


def submissions(spark, rows):
    return spark.createDataFrame(
        [(i, url, score, f"t{i}", None if i % 3 == 0 else "s", T0 + datetime.timedelta(days=i)) for i, url, score in rows],
        DDL,
    )


def test_arrays_are_aligned_and_every_group_is_tested(spark):
    rows = [(5, "b", 1), (1, "b", 1), (3, "b", 1), (2, "a", 2), (4, "c", -5), (6, "c", 9), (7, "d", None), (8, "d", 3)]
    records = {r.url: r for r in build_url_records(submissions(spark, rows)).collect()}
    # "a" sums to 2 only; the last group in url order gets the same test as all others.
    assert set(records) == {"b", "c", "d"}
    b = records["b"]
    assert (b.part, b.total_score, b.meta.id, b.meta.score) == (0, 3, [1, 3, 5], [1, 1, 1])
    assert b.meta.title == ["t1", "t3", "t5"] and b.meta.subreddit == ["s", None, "s"]
    assert b.meta.created_utc[2] == T0 + datetime.timedelta(days=5)
    assert records["d"].meta.score == [0, 3]


def test_hot_url_is_spread_and_stays_whole(spark):
    rows = [(i, "hot", 1) for i in range(1000)] + [(2000 + i, f"u{i}", 1) for i in range(50)]
    subs = submissions(spark, rows)
    records = build_url_records(subs, min_score=1, max_meta_per_row=100).collect()
    hot = [r for r in records if r.url == "hot"]
    assert sorted(r.part for r in hot) == list(range(10))
    assert sorted(i for r in hot for i in r.meta.id) == list(range(1000))
    assert all(r.total_score == 1000 and r.meta.id == sorted(r.meta.id) for r in hot)
    assert len(records) == 60
    # The total decides, not the sum of one part.
    assert {r.url for r in build_url_records(subs, 900, 100).collect()} == {"hot"}


def test_all_parts_reach_the_documents(spark):
    records = build_url_records(submissions(spark, [(i, "hot", 1) for i in range(30)]), 3, 10)
    pages = spark.createDataFrame([("hot", "text", ("T", "en"))], "url string, text string, meta struct<title: string, lang: string>")
    joined = attach_url_meta(pages, records)
    docs = joined.collect()
    # One document, and the score filter sees the total of all parts in each of them.
    assert [r.text for r in with_text(joined).collect()] == ["text"] and {r.text for r in docs if r.part} == {None}
    assert min_total_score(joined, 30).count() == len(docs) == 3 and min_total_score(joined, 31).count() == 0
    assert {r.meta.title for r in docs} == {"T"} and {r.first_created for r in docs} == {T0}
    assert sorted(i for r in docs for i in r.meta.reddit_id) == list(range(30))


def test_parts_survive_url_files(spark, tmp_path):
    rows = [(i, "hot", 1) for i in range(600)] + [(1000 + i, f"u{i:02d}", 3) for i in range(15)]
    records = build_url_records(submissions(spark, rows), 3, 16)
    url_files.write_url_batches(records, str(tmp_path), 10)
    key = lambda r: (r.url, r.part, r.total_score, r.first_created, tuple(r.meta.id))
    back = url_files.read_url_files(spark, str(tmp_path)).collect()
    assert sorted(map(key, back)) == sorted(map(key, records.collect())) and len({r.url for r in back}) == 16
    # No file, hence no task, holds more than one part of the hot URL.
    assert all(len([x for x in back if x.source_file == r.source_file and x.url == "hot"]) == 1 for r in back if r.url == "hot")
    pages = spark.createDataFrame([("hot", "t", ("T",))], "url string, text string, meta struct<title: string>")
    docs = attach_url_meta(pages, url_files.read_url_files(spark, str(tmp_path))).collect()
    assert sorted(i for r in docs for i in r.meta.reddit_id) == list(range(600)) and {r.total_score for r in docs} == {600}


def test_merge_takes_totals_again(spark):
    rows = [(1, "a", 2), (2, "b", 2), (3, "a", 1), (4, "c", 3)]
    subs = submissions(spark, rows)
    runs = [build_url_records(subs.where(c), None) for c in (F.col("id") < 3, F.col("id") >= 3)]
    merged = {r.url: r.meta.id for r in merge_url_records(*runs).collect()}
    assert merged == {r.url: r.meta.id for r in build_url_records(subs).collect()} == {"a": [1, 3], "c": [4]}


def test_any_source_with_the_six_columns(spark):
    own = spark.sql("select 'x' extra, '7' id, 'u' url, 5 score, 't' title, 's' subreddit, '2010-01-01 00:00:00' created_utc")
    record = build_url_records(conform(own)).first()
    assert (record.url, record.meta.id, record.meta.created_utc) == ("u", [7], [T0])


def test_totals(spark):
    rows = [(1, "a", 2), (2, "a", None), (3, "b", 5)]
    got = sorted(tuple(r) for r in url_totals(submissions(spark, rows), 2).collect())
    assert got == [("a", 2, 2), ("b", 1, 5)]


def test_batches_are_exact_and_parts_stay_together(spark):
    rows = [(i, "u005", 1) for i in range(40)] + [(100 + i, f"u{i:03d}", 3) for i in range(25) if i != 5]
    records = build_url_records(submissions(spark, rows), 3, 10)
    batched = url_files.number_url_batches(records, 10).select("url", "url_batch").distinct().collect()
    assert {r.url: r.url_batch for r in batched} == {f"u{i:03d}": i // 10 for i in range(25)}


def test_url_files_round_trip(spark, tmp_path):
    records = build_url_records(submissions(spark, [(i, f"u{i:03d}", 3) for i in range(25)]))
    url_files.write_url_batches(records, str(tmp_path / "b"), 10)
    assert sorted(p.name for p in (tmp_path / "b").iterdir()) == [f"urls_{i}.jsonl.zst" for i in range(3)]
    per_file = url_files.read_url_files(spark, str(tmp_path / "b")).groupBy("source_file").count().collect()
    assert sorted(r["count"] for r in per_file) == [5, 10, 10]
    assert {r.url: r.meta.id for r in url_files.read_url_files(spark, str(tmp_path / "b")).collect()} == {
        f"u{i:03d}": [i] for i in range(25)
    }
    url_files.write_url_files(records, str(tmp_path / "f"), 10)
    assert url_files.read_url_files(spark, str(tmp_path / "f")).count() == 25


def test_count_is_stored_once(spark, tmp_path):
    df, path = spark.range(7), str(tmp_path / "count")
    assert url_files.stored_count(spark, df, path).first().n == 7
    assert url_files.stored_count(spark, spark.range(9), path).first().n == 7
