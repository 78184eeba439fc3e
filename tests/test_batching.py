import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from linkmill.operators import batching
from linkmill.operators.ordinals import with_ordinal, with_running
from pyspark.sql import functions as F


def loop(sizes, n):
    """Add a file, then close the batch if its share is exceeded, at most once per file."""
    total, seen, batch, out = sum(sizes), 0, 0, []
    for size in sizes:
        out.append(batch)
        seen += size
        if seen * n > (batch + 1) * total:
            batch += 1
    return out


def closed_form(sizes, n):
    total, cum, low, out = sum(sizes), 0, None, [0]
    for i, size in enumerate(sizes[:-1]):
        cum += size
        k = 0 if total == 0 or cum == 0 else (cum * n - 1) // total
        low = k - i if low is None else min(low, k - i)
        out.append(i + min(1, low))
    return out


@given(st.lists(st.integers(0, 50), min_size=1, max_size=20), st.integers(1, 30))
def test_closed_form_is_the_loop(sizes, n):
    assert closed_form(sizes, n) == loop(sizes, n)


@pytest.mark.parametrize(
    "sizes, n", [([5, 5, 5, 5], 2), ([100, 1, 1, 1], 4), ([0, 0, 3], 2), ([0], 3), ([1, 2], 9), (None, 6)]
)
def test_packing(spark, sizes, n):
    sizes = sizes or [random.Random(3).randrange(20) for _ in range(60)]
    files = spark.createDataFrame(list(enumerate(sizes)), "file_id long, n_docs long")
    got = {r.file_id: r.batch for r in batching.pack_files(files, n).collect()}
    assert [got[i] for i in range(len(sizes))] == loop(sizes, n)


def test_ordinals_in_files_with_one_huge_file(spark):
    rows = [("huge", i * 7 % 1009) for i in range(1009)] + [("a", 5), ("a", 3), ("z", 1)]
    df = spark.createDataFrame(rows, "source_file string, doc_id long").repartition(4)
    got = {(r.source_file, r.doc_id): r.doc_ord for r in batching.with_document_ordinal(df, ["doc_id"]).collect()}
    want = {}
    for name in {r[0] for r in rows}:
        want |= {(name, d): i for i, d in enumerate(sorted(d for f, d in rows if f == name))}
    assert got == want


def test_running_values_cross_slices(spark):
    values = [random.Random(1).randrange(-50, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v long").repartition(5)
    got = with_running(df, ["i"], {"total": ("sum", F.col("v")), "low": ("min", F.col("v"))}).orderBy("i").collect()
    assert [r.total for r in got] == [sum(values[: i + 1]) for i in range(500)]
    assert [r.low for r in got] == [min(values[: i + 1]) for i in range(500)]


def test_fixed_batches(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(100)], "url string").repartition(7)
    got = {r.url: r.b for r in batching.fixed_batches(df, ["url"], 30, skip=5, name="b").collect()}
    assert got == {f"{i:03d}": (i - 5) // 30 for i in range(5, 100)}


def test_file_ids(spark):
    docs = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "source_file string, doc_id long")
    files = batching.with_file_id(batching.documents_per_file(docs))
    assert sorted((r.source_file, r.n_docs, r.file_id) for r in files.collect()) == [("a", 1, 0), ("b", 2, 1)]
    assert {r.doc_id: r.file_id for r in batching.attach_file_id(docs, files).collect()} == {1: 1, 2: 0, 3: 1}


def test_order_is_by_bytes(spark):
    urls = ["http://B", "http://a", "http://é", "http://_"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = with_ordinal(df, ["url"], "n").orderBy("n").collect()
    assert [r.url for r in rows] == sorted(urls, key=lambda u: u.encode())
