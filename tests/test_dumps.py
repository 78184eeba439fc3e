import bz2
import datetime
import hashlib
import json
import lzma

import pytest
import zstandard

from linkmill.operators.submissions import dedup_by_id, in_period, quarantine, to_submissions
from linkmill.functions.scalars import parse_month
from linkmill.sources import dumps, files
from linkmill.sources import submissions as sub_files

LINK = {"id": "10z", "is_self": False, "url": "http://a.com/é", "score": 7, "title": "t", "subreddit": "s",
        "created_utc": 1136073600}
TIME = datetime.datetime(2006, 1, 1)


def post(**changes):
    made = {**LINK, **changes}
    return {k: v for k, v in made.items() if v is not ...}


POSTS = [
    post(),
    post(id="2", created_utc="1136073600"),
    post(id="3", created_utc=1136073601.9),
    post(id="4", score=...),
    post(id="5", score=None),
    post(id="6", score=-4, title=None, subreddit=...),
    post(id="7", is_self=True),
    post(id="8", is_self=...),
    post(id="9", is_self=None),
    post(id="a", url=""),
    post(id="b", url=None),
    post(id="c", url=...),
    post(id=...),
    post(id="t3_x"),
    post(id="d", created_utc=...),
    post(id="e", created_utc="soon"),
]
LINES = [json.dumps(p, ensure_ascii=i % 2 == 0) for i, p in enumerate(POSTS)] + ['{"id": "f", "is_sel', "17", '["x"]']
# The last line has no newline at its end.
DATA = "\n".join(LINES).encode()


@pytest.fixture
def dump_dir(tmp_path):
    (tmp_path / "2011").mkdir()
    (tmp_path / "a.json").write_bytes(DATA)
    (tmp_path / "b.bz2").write_bytes(bz2.compress(DATA))
    (tmp_path / "2011" / "c.zst").write_bytes(zstandard.ZstdCompressor().compress(DATA))
    # Two xz streams in one file, cut in the middle of a line.
    (tmp_path / "2011" / "d.xz").write_bytes(lzma.compress(DATA[:100]) + lzma.compress(DATA[100:]))
    return str(tmp_path)


def test_every_codec_gives_the_same_submissions(spark, dump_dir):
    posts = dumps.read_dumps(spark, dump_dir)
    rows = to_submissions(posts, keep=["source_file"]).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.source_file[-5:], set()).add((r.id, r.url, r.score, r.title, r.subreddit, r.created_utc))
    assert set(by_file) == {".json", "b.bz2", "c.zst", "/d.xz"}
    later = TIME + datetime.timedelta(seconds=1)
    want = {
        (int("10z", 36), LINK["url"], 7, "t", "s", TIME),
        (2, LINK["url"], 7, "t", "s", TIME),
        (3, LINK["url"], 7, "t", "s", later),
        (4, LINK["url"], 0, "t", "s", TIME),
        (5, LINK["url"], 0, "t", "s", TIME),
        (6, LINK["url"], -4, None, None, TIME),
    }
    assert all(found == want for found in by_file.values())


def test_no_line_is_lost(spark, dump_dir):
    posts = dumps.read_dumps(spark, dump_dir, "a.json")
    bad = [r.reason for r in quarantine(posts).collect()]
    assert sorted(bad) == ["bad_created_utc"] * 2 + ["bad_id"] * 2 + ["bad_json"] * 3
    skipped = 6
    assert to_submissions(posts).count() + len(bad) + skipped == len(LINES)


def test_scores_and_ids_in_odd_forms(spark, tmp_path):
    odd = {"5.0": 5, "-2.7": -2, '"8"': 8, "null": 0, '"x"': 0, "1e2": 100}
    ids = {"1y2p0ij32e8e7": 2**63 - 1, "1y2p0ij32e8e8": None, "0000000000001": 1, "0": 0, "zzzzzzzzzzzzzzz": None, "00zz": 1295, "a\n": None}
    head = '"url":"http://a.com/x","is_self":false,"created_utc":1'
    lines = [f'{{"id":"{i + 10}",{head},"score":{s}}}' for i, s in enumerate(odd)]
    lines += [json.dumps({"id": i, "url": "http://a.com/x", "is_self": False, "created_utc": 1}) for i in ids]
    posts = dumps.parse_posts(spark.createDataFrame([(x,) for x in [*lines, ""]], "value string"))
    rows = to_submissions(posts).collect()
    assert [r.score for r in rows[: len(odd)]] == list(odd.values())
    assert [r.id for r in rows[len(odd) :]] == [v for v in ids.values() if v is not None]
    assert [r.reason for r in quarantine(posts).collect()] == ["bad_id"] * 3


def test_blank_lines_count_and_names_may_be_odd(spark, tmp_path):
    for name in ("a b.jsonl", "a[1].jsonl", "50%25.jsonl", "x.jsonl"):
        (tmp_path / name).write_text('{"id":"1"}\n\n\n{"id":"2"}')
    (tmp_path / "Y Z.XZ").write_bytes(lzma.compress(b'{"id":"1"}\n\n'))
    counts = {r.source_file: r.n_lines for r in files.lines_per_file(spark, str(tmp_path)).collect()}
    assert counts == {"a b.jsonl": 4, "a[1].jsonl": 4, "50%25.jsonl": 4, "x.jsonl": 4, "Y Z.XZ": 2}
    assert dumps.read_dumps(spark, str(tmp_path)).count() == 9


def test_files_of_one_name_are_counted_apart(spark, tmp_path):
    for folder, n in (("a", 2), ("b", 5)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text("l\n" * n)
    (tmp_path / "a" / "x.xz").write_bytes(lzma.compress(b"l\n"))
    (tmp_path / "b" / "x.xz").write_bytes(lzma.compress(b""))
    got = {r.path.removeprefix(str(tmp_path)): r.n_lines for r in files.lines_per_file(spark, str(tmp_path)).collect()}
    assert got == {"/a/x.txt": 2, "/b/x.txt": 5, "/a/x.xz": 1, "/b/x.xz": 0}


def test_unknown_formats_are_refused(spark, tmp_path):
    (tmp_path / "a.7z").write_bytes(b"x")
    with pytest.raises(ValueError):
        dumps.read_dumps(spark, str(tmp_path))


def test_score_filtered_files_keep_their_codec(spark, tmp_path):
    packed = zstandard.ZstdCompressor().compress(b'{"text":"a","meta":{}}\n{"text":"b","meta":{}}')
    (tmp_path / "scrapes_0.jsonl.zst.minscored").write_bytes(packed)
    assert files.read_lines(spark, str(tmp_path), "*.minscored").count() == 2


def test_line_counts_and_sizes(spark, dump_dir):
    counts = {r.source_file: r.n_lines for r in files.lines_per_file(spark, dump_dir).collect()}
    assert counts == dict.fromkeys(["a.json", "b.bz2", "c.zst", "d.xz"], len(LINES))
    one = files.total_size(spark, dump_dir, "a.json").first()
    assert (one.n_files, one.total_bytes) == (1, len(DATA))


def test_first_of_equal_ids_survives(spark):
    rows = [(1, "b", 5, "x", "s", TIME), (1, "a", 1, "x", "s", TIME), (2, "c", 1, None, None, TIME)]
    df = spark.createDataFrame(rows, "id long, url string, score long, title string, subreddit string, created_utc timestamp_ntz")
    assert sorted((r.id, r.url) for r in dedup_by_id(df).collect()) == [(1, "a"), (2, "c")]


def test_periods_are_half_open_whole_months(spark, tmp_path):
    times = ["2005-05-31 23:59:59", "2005-06-01 00:00:00", "2006-12-31 23:59:59", "2007-01-01 00:00:00"]
    df = spark.createDataFrame([(i, "u", 1, "t", "s", t) for i, t in enumerate(times)],
                               "id long, url string, score long, title string, subreddit string, created_utc string")
    df = df.withColumn("created_utc", df.created_utc.cast("timestamp_ntz"))
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(in_period(df)) == [0, 1, 2, 3]
    assert ids(in_period(df, None, parse_month("12,2006"))) == [1, 2]
    assert ids(in_period(df, parse_month("12,2006"), now=datetime.datetime(2007, 1, 15))) == [2, 3]
    path = str(tmp_path / "table")
    sub_files.write_submissions(df, path)
    scan = sub_files.scan_submissions(spark, path, parse_month("12,2006"), parse_month("12,2006"))
    assert ids(scan) == [2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(created_utc)" in plan


def test_checksums_against_hashlib(spark, dump_dir, tmp_path):
    sums = {r.file_name: r.actual for r in dumps.file_checksums(spark, dump_dir).collect()}
    assert sums["a.json"] == hashlib.sha256(DATA).hexdigest()
    manifest = tmp_path / "sha256sums.txt"
    manifest.write_text(f"{sums['a.json'].upper()}  a.json\n\n{'0' * 64}  b.bz2\n")
    checked = dumps.verify_files(dumps.file_checksums(spark, dump_dir, "*.*[2tn]"), dumps.read_manifest(spark, str(manifest)))
    status = {r.file_name: r.status for r in checked.collect()}
    assert status["a.json"] == "ok" and status["b.bz2"] == "mismatch" and status["c.zst"] == "unlisted"


def test_dump_inventory(spark):
    names = ["RS_v2_2010-12.xz", "RS_2010-12.zst", "RS_2011-01.bz2", "RS_2011-01.xz", "RS_2011-03.bz2", "RS_2011-03.zst"]
    found = dumps.dump_inventory(
        spark, spark.createDataFrame([(n,) for n in names], "file_name string"),
        datetime.date(2010, 11, 1), datetime.date(2011, 3, 1),
    )
    assert sorted(r.file_name for r in found.collect()) == ["RS_2011-01.xz", "RS_2011-03.zst", "RS_v2_2010-12.xz"]


def test_tsv_round_trip(spark, tmp_path):
    rows = [(1, 'http://a.com/"q"', -1, "a\tb", None, TIME)]
    df = spark.createDataFrame(rows, "id long, url string, score long, title string, subreddit string, created_utc timestamp_ntz")
    sub_files.write_submissions_tsv(df, str(tmp_path / "t"))
    back = sub_files.read_submissions_tsv(spark, str(tmp_path / "t")).first()
    assert tuple(back) == (1, 'http://a.com/"q"', -1, "a b", None, TIME)
