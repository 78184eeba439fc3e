import datetime
import random

from linkmill.operators.url_records import build_url_records, merge_url_records
from linkmill.sources.url_store import UrlStore

T0 = datetime.datetime(2010, 1, 1)
DDL = "id long, url string, score long, title string, subreddit string, created_utc timestamp_ntz"


def run(spark, rows):
    full = [(i, u, s, f"t{i}", None, T0 + datetime.timedelta(days=d)) for i, u, s, d in rows]
    return build_url_records(spark.createDataFrame(full, DDL), min_score=None)


def rows_of(df):
    return sorted((r.url, r.part, r.total_score, r.meta.id, r.meta.score, r.first_created) for r in df.collect())


def names(path, version):
    return {(p.parent.name, p.name) for p in (path / "records" / f"version={version}").rglob("part-*.parquet")}


def test_merged_periods_equal_one_merge_of_all(spark, tmp_path):
    rng = random.Random(3)
    store = UrlStore(str(tmp_path), buckets=5)
    periods = [[(rng.randrange(60), f"u{rng.randrange(12)}", rng.randrange(-2, 5), rng.randrange(100)) for _ in range(n)] for n in (40, 25, 3, 0)]
    # Ids are unique within a period, but a later one may give an id another URL, an earlier time, or the same row.
    periods = [list({r[0]: r for r in p}.values()) for p in periods]
    runs = [run(spark, p) for p in periods]
    for version, one in enumerate(runs):
        store.merge(one, version)
        want = merge_url_records(*runs[: version + 1], min_score=None)
        assert rows_of(store.read(spark, min_score=None)) == rows_of(want)
    assert rows_of(store.read(spark)) == rows_of(merge_url_records(*runs))
    assert store.versions(spark) == [0, 1, 2, 3]
    assert rows_of(store.read(spark, 1, None)) == rows_of(merge_url_records(*runs[:2], min_score=None))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = UrlStore(str(tmp_path), buckets=16)
    store.merge(run(spark, [(i, f"u{i}", 5, i) for i in range(60)]), 0)
    before = names(tmp_path, 0)
    store.merge(run(spark, [(100, "u7", 1, 1), (101, "u7", 1, 2)]), 1)
    assert names(tmp_path, 0) == before and len({b for b, _ in names(tmp_path, 1)}) == 1
    held = {r.bucket: r.held_by for r in store.manifest(spark, 1).collect()}
    assert sorted(held.values()).count(1) == 1 and len(held) == len({b for b, _ in before})
    assert [r.meta.id for r in store.read(spark).where("url = 'u7'").collect()] == [[7, 100, 101]]
    # Only the folders that the manifest names are read.
    plan = store.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_version_can_be_written_again(spark, tmp_path):
    store = UrlStore(str(tmp_path), buckets=4)
    store.merge(run(spark, [(1, "a", 5, 1), (2, "b", 5, 1)]), 0)
    for _ in range(2):
        store.merge(run(spark, [(3, "a", 1, 1), (2, "c", 1, 0)]), 1)
        got = {r[0]: (r[2], r[3]) for r in rows_of(store.read(spark, min_score=None))}
        assert got == {"a": (6, [1, 3]), "c": (1, [2])}
    assert UrlStore(str(tmp_path / "none")).read(spark).count() == 0


def test_a_hot_url_stays_in_parts(spark, tmp_path):
    store = UrlStore(str(tmp_path), buckets=4, max_meta_per_row=10)
    store.merge(run(spark, [(i, "hot", 1, 1) for i in range(30)]), 0)
    store.merge(run(spark, [(100 + i, "hot", 1, 1) for i in range(30)]), 1)
    rows = store.read(spark).collect()
    assert len(rows) == 6 and {r.total_score for r in rows} == {60} and sorted(i for r in rows for i in r.meta.id) == [*range(30), *range(100, 130)]
