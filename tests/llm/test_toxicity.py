import zlib

import numpy as np
import pytest

from linkmill.llm import hashing, toxicity
from linkmill.llm.toxicity import Net, classify, op2_toxicity, thresholds, train


@pytest.fixture(scope="module")
def made():
    """Texts of random syllables, some with invented insults in many forms; held-out ones have forms never seen."""
    rng = np.random.default_rng(7)
    syllables = ["an", "ther", "ing", "ou", "éa", "st", "be", "wor"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows = []
    for i in range(700):
        words = [word() for _ in range(rng.integers(20, 90))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.integers(len(words)), rng.choice(["schmuz", "klodd"]) + word())
        rows.append((i, " ".join(words), "xx" if i % 2 else "yy", int(toxic)))
    return rows


def plain_score(net, text):
    """One text, one filter, one place at a time."""
    rows = [r for _, _, t, _ in hashing.batches([text]) for r in toxicity.word_rows(t)]
    x = [np.zeros(toxicity.WIDTH, np.float32)] * 2 + [net.embedding[r].sum(axis=0) for r in rows]
    z = float(net.offset)
    for k, n in enumerate(toxicity.SPANS):
        for f in range(toxicity.FILTERS):
            values = []
            for at in range(len(x)):
                values.append(net.offsets[n][f] + sum(x[at + j] @ net.filters[n][j, :, f] for j in range(n) if at + j < len(x)))
            z += max(max(values), 0) * net.weights[k * toxicity.FILTERS + f]
    return 1 / (1 + np.exp(-z))


def test_scores_equal_plain_loops_however_texts_are_batched(monkeypatch):
    net = Net(np.random.default_rng(1))
    texts = ["", "one", "two words", "a b c d e f g h", "x é z " * 30, " ", "schmuz " * 9]
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(net.score(texts), want, atol=1e-5)
    monkeypatch.setattr(hashing, "SLAB", 24)
    assert np.allclose(net.score(texts), want, atol=1e-5)


def test_held_out_accuracy_and_edge_cases(spark, made):
    rows = [(i, t, lang, 0.5) for i, t, lang, _ in made] + [(None, None, None, 0.5), (10_000, "", "zz", 0.5), (0, made[0][1], "yy", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in made] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and 0 <= r.threshold <= 1 for r in got)
    truth = {i: y for i, _, _, y in made}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([(r.score >= 0.7) == bool(truth[r.doc_id]) for r in held]) >= 0.97
    assert np.mean([r.toxic_by_language == bool(truth[r.doc_id]) for r in held]) >= 0.97
    assert classify(docs.limit(0), labels).count() == 0
    assert all(r.score < 0.5 for r in classify(docs, labels.limit(0)).collect())


def test_language_chooses_the_threshold_and_nothing_else(spark, made):
    docs = spark.createDataFrame([r[:3] for r in made[:200]], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in made], "doc_id long, toxic int")
    swapped = spark.createDataFrame([(i, t, "yy" if lang == "xx" else "xx") for i, t, lang, _ in made[:200]], docs.schema)
    a = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in classify(swapped, labels).collect()}


def test_thresholds():
    found = thresholds(np.array([0.1, 0.2, 0.8, 0.9, 0.4, 0.6]), [0, 0, 1, 1, 0, 1], ["a", "a", "a", "a", "b", None])
    assert found["a"] == 0.5 and "b" not in found and 0.4 <= found[None] <= 0.6
    assert thresholds(np.array([]), [], []) == {None: toxicity.CUT}
    assert train([], np.array([])).score(["x"])[0] < 0.5


def test_whole_table(spark, sf):
    rows = op2_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_sample_is_bounded_by_rows_and_taken_from_usable_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAINED", 20)
    monkeypatch.setattr(toxicity, "CALIBRATED", 3)
    monkeypatch.setattr(toxicity, "LANGUAGES", 2)
    # One labelled id comes 10,000 times, with two texts; most labels have no document, or one that is too long.
    rows = [(5, "again " + "b" * (i % 2), "xx") for i in range(10_000)] + [(100 + i, f"text {i}", ["xx", "yy", None, "zz"][i % 4 if i < 360 else 0]) for i in range(400)]
    rows += [(1000 + i, "w " * 15_000, "xx") for i in range(20)] + [(2000, None, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 100_000)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels, "doc_id", "text", "lang")
    fit = got[got["use"] == "train"]
    assert list(fit["toxic"].value_counts().sort_index()) == [20, 20] and len(got) <= 40 + 2 * 3
    assert got["text"].str.startswith("again").sum() <= 1 and got["text"].str.len().max() <= toxicity.TRAINED_CHARS
    rest = got[got["use"] == "calibrate"]
    assert len(rest) == 6 and "xx" in set(rest["lang"])
    assert toxicity.labelled_sample(docs, labels.limit(0), "doc_id", "text", "lang").empty


def test_every_labelled_document_trains_in_several_parts(spark, made, monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 120)
    # Toxic texts are all long, so a bound on length or rows would leave one label only.
    rng = np.random.default_rng(3)
    filler = " ".join(w for _, t, _, y in made if not y for w in t.split() if len(w) < 9)
    rows = [(i, t if not y else t + " " + filler[(at := int(rng.integers(9_000))) : at + 21_000], lang) for i, t, lang, y in made]
    docs = spark.createDataFrame(rows + rows[:9] + [(None, "x", "xx")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in made] + [(5000, 1)], "doc_id int, toxic int")
    known = toxicity.labelled(docs, labels, "doc_id", "text", "lang").collect()
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert sorted(r.text for r in known) == sorted(t for _, t, _ in learnt) and len({r.part for r in known}) > 3
    got = classify(docs.limit(700), labels).where("held_out").collect()
    truth = {i: y for i, _, _, y in made}
    assert all(len(t) > 20_000 for i, t, _ in rows if truth[i])
    assert np.mean([(r.score >= 0.7) == bool(truth[r.doc_id]) for r in got]) >= 0.95


def test_long_texts_train_like_short_ones(monkeypatch, made):
    words = toxicity.words_of([t for _, t, _, _ in made[:20]] + [""])
    net = Net(np.random.default_rng(1))
    whole = toxicity.Trainee(net).tops(words)
    assert np.allclose(whole[0][0], net.pooled(*toxicity.laid_out(words[0].astype(np.int32), np.zeros(len(words[0]), int), 1))[0], atol=1e-6)
    monkeypatch.setattr(toxicity, "PLACES", 7)
    cut = toxicity.Trainee(net).tops(words)
    assert np.allclose(whole[0], cut[0], atol=1e-6) and np.array_equal(whole[1], cut[1])


def test_thresholds_are_counted_over_all_rows_of_all_languages(spark):
    rng = np.random.default_rng(5)
    # 70 languages of 40 rows, and one whose rows have one label.
    langs = [f"l{i % 70}" for i in range(2800)] + ["one"] * 50 + [None] * 9 + [""] * 9
    scores = rng.permutation(10_000)[: len(langs)] / 10_000 + 0.00003
    toxic = (scores + rng.normal(0, 0.2, len(langs)) > 0.6) & (np.array(langs, object) != "one")
    rows = [(lang, int(y), float(s)) for lang, y, s in zip(langs, toxic, scores, strict=True)]
    overall, cuts = toxicity.counted_thresholds(spark.createDataFrame(rows, "lang string, toxic int, score double"))
    assert {None: overall, **{r.lang: r.cut for r in cuts.collect()}} == thresholds(scores, toxic, langs)
    assert cuts.count() == 70
