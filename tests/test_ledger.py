import shutil

from linkmill.operators.ledger import add_batch, fold

DOCS = "text string, lang string, source string"


def test_folded_sums_equal_a_full_count_and_read_no_text(spark, tmp_path):
    path, ledger = str(tmp_path / "documents"), str(tmp_path / "ledger")
    batches = [
        [("é" * 3, "en", "a"), ("", "de", "a"), (None, None, "b")],
        [("word", "en", "b")] * 5,
        [],
        [("x", "fr", "a"), ("yy", "en", "c")],
    ]
    for n in (0, 1, 1, 2, 3):
        docs = spark.createDataFrame(batches[n], DOCS)
        add_batch(docs, path, ledger, n, ("lang", "source"), docs.where("lang = 'en'").limit(1), docs.where("source = 'c'"))
    whole = [r for b in batches for r in b]
    assert spark.read.parquet(path).count() == len(whole)
    shutil.rmtree(path)  # from here on only the ledger is there
    got = {r.lang: r for r in fold(spark, ledger, ("lang",)).collect()}
    for lang in ("en", "de", "fr", None):
        rows = [t for t, x, _ in whole if x == lang]
        assert (got[lang].n_docs, got[lang].total_chars) == (len(rows), sum(len(t or "") for t in rows))
        assert got[lang].total_bytes == sum(len((t or "").encode()) for t in rows)
    assert (got["en"].n_duplicates, got["en"].n_errors, got["en"].useful_pct) == (3, 1, 57.14)
    total = fold(spark, ledger).first()
    assert (total.n_docs, total.n_duplicates, total.n_errors, total.error_pct) == (len(whole), 3, 1, 9.09)
    assert fold(spark, str(tmp_path / "none")).first().n_docs == 0 and fold(spark, str(tmp_path / "none"), ("lang",)).count() == 0
