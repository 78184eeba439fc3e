import datetime
import io
import json
import os

import pytest
import zstandard
from pyspark.sql import functions as F

from linkmill.operators.documents import min_total_score, successful
from linkmill.schemas import DOCUMENT
from linkmill.sources import zstd
from linkmill.sources.documents import parse_documents, read_documents, write_documents


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_text_shapes(spark):
    df = lines(spark, '"bare \\"q\\""', '{"text":"one"}', '{"text":["a","b"],"meta":{}}', '{"text":"[\\"x\\"]"}')
    assert [r.text for r in parse_documents(df, get_meta=False).collect()] == ['bare "q"', "one", "a\n\nb", '["x"]']
    kept = parse_documents(df, get_meta=False, autojoin_paragraphs=False).collect()
    assert [r.text for r in kept] == [['bare "q"'], ["one"], ["a", "b"], ['["x"]']]


def test_meta_shapes(spark):
    df = lines(spark, '{"text":"a"}', '{"text":"b","meta":{"x":[1, 2]}}')
    assert [r.meta for r in parse_documents(df).collect()] == ["{}", '{"x":[1,2]}']


def test_bare_string_has_no_meta(spark):
    with pytest.raises(Exception, match="no meta"):
        parse_documents(lines(spark, '"bare"')).collect()


@pytest.mark.parametrize("bad", ['{"text":', '{"meta":{}}', "5"])
def test_other_lines_are_errors(spark, bad):
    with pytest.raises(Exception, match="not a document"):
        parse_documents(lines(spark, bad), get_meta=False).collect()


def test_zstd_files_are_plain_json_lines(spark, tmp_path):
    time = datetime.datetime(2020, 1, 2, 3, 4, 5)
    meta = (None, "en", "http://é.com", 2, 0.5, "newspaper", "é.com", [1, 2], ["s", None], [3, 4], ["t", "u"], [time, time])
    docs = spark.createDataFrame([(f"line\n{i}", meta) for i in range(25)], DOCUMENT)
    path = str(tmp_path / "out")
    write_documents(docs.repartition(3), path, prefix="scrapes_", max_records_per_file=5)
    names = [n for n in os.listdir(path)]
    assert all(n.startswith("scrapes_") and n.endswith(".jsonl.zst") for n in names)
    seen = []
    for name in names:
        with open(f"{path}/{name}", "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8").read()
        rows = [json.loads(row) for row in text.splitlines()]
        assert 0 < len(rows) <= 5
        seen += [r["text"] for r in rows]
        assert rows[0]["meta"]["reddit_created_utc"][0] == time.isoformat()
        assert rows[0]["meta"]["title"] is None
    assert sorted(seen) == sorted(f"line\n{i}" for i in range(25))
    back = read_documents(spark, path, meta_schema=DOCUMENT["meta"].dataType)
    assert sorted(map(tuple, back.select("text", "meta").collect())) == sorted(map(tuple, docs.collect()))
    write_documents(docs.limit(1), path)
    assert read_documents(spark, path).count() == 1


def test_score_sums(spark):
    docs = spark.createDataFrame(
        [("a", ([1, 2],)), ("b", ([5, -3],)), ("c", ([],)), ("d", (None,)), ("e", ([None, 3],))],
        "text string, meta struct<reddit_score: array<long>>",
    )
    assert [r.text for r in min_total_score(docs).collect()] == ["a", "e"]
    assert min_total_score(docs, 0).count() == 5
    older = docs.select("text", F.struct(F.col("meta.reddit_score").alias("reddit_scores")).alias("meta"))
    assert [r.text for r in min_total_score(older).collect()] == ["a", "e"]
    as_json = docs.select("text", F.to_json("meta").alias("meta"))
    assert [r.text for r in min_total_score(as_json).collect()] == ["a", "e"]


def test_blank_text_is_no_document(spark):
    rows = [("a", True), (" \n \t", True), ("", True), (None, True), ("b", False)]
    df = spark.createDataFrame(rows, "text string, success boolean")
    assert [r.text for r in successful(df).collect()] == ["a"]


def test_zst_files_count_by_their_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"l{i}", f"f{i % 3}.jsonl.zst") for i in range(30)], "value string, file_name string")
    grouped = rows.repartition("file_name").sortWithinPartitions("file_name")
    manifest = zstd.write_zst_lines(grouped, path)
    assert sorted((r.name, r.n_lines) for r in manifest.collect()) == [(f"f{i}.jsonl.zst", 10) for i in range(3)]
    assert sorted(os.listdir(path)) == ["f0.jsonl.zst", "f1.jsonl.zst", "f2.jsonl.zst"]
    # Following it again, as after a lost driver, changes nothing; a file that is nowhere is an error.
    zstd.follow_manifest(manifest, f"{path}/_staging-gone", path)
    os.remove(f"{path}/f1.jsonl.zst")
    with pytest.raises(Exception, match="neither staged nor moved"):
        zstd.follow_manifest(manifest, f"{path}/_staging-gone", path)
    # Appending keeps older files; overwriting drops those the new manifest doesn't name, none at all if it is empty.
    zstd.write_zst_lines(rows.drop("file_name").limit(2), path, prefix="more-", mode="append")
    assert len(os.listdir(path)) == 3
    zstd.write_zst_lines(grouped.where("file_name like 'f0%'"), path)
    assert os.listdir(path) == ["f0.jsonl.zst"]
    zstd.write_zst_lines(grouped.limit(0), path)
    assert os.listdir(path) == []
