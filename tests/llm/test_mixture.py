import duckdb
import pytest
from pyspark.sql import functions as F

from linkmill.llm import mixture
from linkmill.llm.mixture import leaf_budgets, mix


def filled(budget, nodes):
    """Water-filling by hand: ``nodes`` are (weight, capacity); real numbers."""
    shares, left, open_ = [0.0] * len(nodes), float(budget), set(range(len(nodes)))
    while open_:
        weights = sum(nodes[i][0] for i in open_)
        full = {i for i in open_ if nodes[i][1] <= left * nodes[i][0] / weights}
        if not full:
            for i in open_:
                shares[i] = left * nodes[i][0] / weights
            break
        for i in full:
            shares[i] = nodes[i][1]
        left -= sum(nodes[i][1] for i in full)
        open_ -= full
    return shares


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = [("web", "en", "src0", 1000), ("web", "de", "src0", 10), ("web", "de", "src1", 5), ("news", "en", "src5", 300), ("other", "", "", 2)]
    got = {tuple(r)[:3]: r.budget for r in leaf_budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")).collect()}
    assert sum(got.values()) == 1317
    domains = filled(1317, [(45, 4060), (20, 1200), (5, 8)])
    web = filled(domains[0], [(60, 4000), (15, 60)])
    # German is short of tokens within web, and English of web, not another domain, takes what it leaves.
    assert got["other", "", ""] == 8 and got["web", "de", "src0"] == 40 and got["web", "de", "src1"] == 20
    assert abs(got["web", "en", "src0"] - web[0]) <= 1 and abs(got["news", "en", "src5"] - domains[1]) <= 1


def rows_of(n):
    return [(i, "w " * (i % 13), ["en", "de", "fr", None][i % 4], f"src{i % 23}" if i % 29 else None) for i in range(n)]


@pytest.mark.parametrize("digits, levels", [(2, 2), (1, 3), (1, 1)])
def test_equals_sql_and_gives_each_budget_exactly(spark, tmp_path, monkeypatch, digits, levels):
    monkeypatch.setattr(mixture, "RANGE_DIGITS", digits)
    monkeypatch.setattr(mixture, "RANGE_LEVELS", levels)
    path = str(tmp_path / "documents.parquet")
    rows = [*rows_of(600), (700, None, "en", "src0"), (701, "", "en", "src0"), (None, "a b c", "en", "src0"), (5, "w " * 5, "de", "src5"), (5, "w " * 5, "de", "src5"), (702, "long " * 100_000, "es", "src3")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, range int").write.parquet(path)
    got = [tuple(r) for r in mixture.op9_mixture(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    assert sorted(got, key=repr) == sorted(con.execute(mixture.ORACLE).fetchall(), key=repr)
    assert sum(r[6] for r in got) == sum(len((r[1] or "").split()) for r in rows)
    assert all(0 < r[6] <= r[5] and 1 <= r[4] <= mixture.EPOCHS for r in got)
    assert sum(r[6] < r[5] for r in got) <= len({r[1:4] for r in got})  # one cut document a leaf at most


def test_seed_budget_and_empty_table(spark):
    docs = spark.createDataFrame(rows_of(300), "doc_id long, text string, lang string, source string")
    a, b = (sorted(map(tuple, mix(docs, budget_percent=30, seed=s).collect())) for s in (1, 2))
    assert a != b and sum(r[6] for r in a) == sum(r[6] for r in b)
    everything = mix(docs, budget_percent=1000).agg(F.sum("take_tokens")).first()[0]
    assert everything == 4 * sum(len(r[1].split()) for r in rows_of(300))
    assert mix(docs.limit(0)).count() == 0 and mix(docs, budget_percent=0).count() == 0
