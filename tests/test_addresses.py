import bz2
import random

import pytest

from linkmill.operators.bitmaps import ordinal_bitmaps, without_addresses, write_without
from linkmill.sources.files import numbered_lines

DOCS = "source_file string, doc_ord long, text string"


@pytest.mark.parametrize("splits_at_once", [0, 1_000_000])
def test_line_numbers_equal_enumerate_over_many_splits(spark, tmp_path, splits_at_once):
    rng = random.Random(7)
    want = {}
    for name, n, end in (("a.txt", 3000, "\n"), ("b.txt", 700, ""), ("c.txt", 0, ""), ("d.txt", 1, ""), ("e.txt", 40, "\n\n\n"), ("f.txt.bz2", 5000, "\n")):
        lines = ["".join(rng.choice("abc é") for _ in range(rng.choice([0, 1, 20, 3000 if i == 5 else 40]))) for i in range(n)]
        data = ("\n".join(lines) + end).encode()
        (tmp_path / name).write_bytes(bz2.compress(data) if name.endswith("bz2") else data)
        text = data.decode()
        want[name] = text.split("\n")[: -1 if text.endswith("\n") or not text else None]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = numbered_lines(spark, str(tmp_path), splits_at_once)
        assert rows.rdd.getNumPartitions() > 20 or not splits_at_once
        got = sorted((r.source_file.rsplit("/", 1)[1], r.line, r.value) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((name, i, v) for name, lines in want.items() for i, v in enumerate(lines))


def test_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    plan = numbered_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan


@pytest.mark.parametrize("maps_at_once", [1, 2, 3, 100])
def test_removal_equals_an_anti_join(spark, tmp_path, maps_at_once):
    rng = random.Random(maps_at_once)
    rows = [(f, o, f"{f}{o}") for f in ("a", "b", "c", "d") for o in [0, 1, 7, 8, 32767, 32768, 32769, 65535, 65536, 200_000, *rng.sample(range(300_000), 40)]]
    rows = list(dict.fromkeys(rows)) + [(None, 1, "no file"), ("a", None, "no number"), ("z", 5, "no map")]
    gone = [(f, o) for f, o, _ in rows if f in ("a", "b", "c") and o is not None and (o in (0, 7, 32767, 32768, 65535) or rng.random() < 0.4)]
    docs = spark.createDataFrame(rows, DOCS)
    dropped = spark.createDataFrame(gone + gone[:5] + [("nowhere", 3)], "source_file string, doc_ord long")
    passes = write_without(docs, dropped, str(tmp_path / "out"), maps_at_once=maps_at_once)
    assert passes == -(-ordinal_bitmaps(dropped).count() // maps_at_once)
    got = spark.read.schema(docs.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted(r.text for r in got) == sorted(t for f, o, t in rows if (f, o) not in set(gone))


def test_nothing_dropped_and_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([("a", 0, "x")], DOCS)
    assert write_without(docs, docs.select("source_file", "doc_ord").limit(0), str(tmp_path / "a")) == 1
    assert spark.read.schema(docs.schema).parquet(str(tmp_path / "a")).count() == 1
    assert write_without(docs.limit(0), docs.select("source_file", "doc_ord"), str(tmp_path / "b")) == 1
    assert spark.read.schema(docs.schema).parquet(str(tmp_path / "b")).count() == 0


def test_texts_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([("a", i, "x") for i in range(50)], DOCS).write.parquet(path)
    docs = spark.read.schema(DOCS).parquet(path)
    maps = ordinal_bitmaps(docs.where("doc_ord % 2 = 0").select("source_file", "doc_ord"))
    maps.write.parquet(str(tmp_path / "maps"))
    kept = without_addresses(docs, spark.read.parquet(str(tmp_path / "maps")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 25 and "BroadcastHashJoin" in plan
    assert not any("Exchange" in line and "BroadcastExchange" not in line for line in plan.splitlines())
