import random

import pytest
import xxhash

from linkmill.llm.exact_dups import located
from linkmill.llm.near_dups import links, near_duplicates, op5_simhash, simhash


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_links(values):
    return {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


def brute_components(ids, values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))]


TEXTS = ["", None, " \t\n", "one", "One", "two words", "a b c", "a b  C", "a b c d", "É é x y", "x " * 200_000, "nb sp x y z q"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_plain_python(text, monkeypatch):
    assert simhash(text or "") & (1 << 64) - 1 == plain(text)
    monkeypatch.setattr("linkmill.llm.near_dups.SLAB", 5)
    if len(text or "") < 1000:
        assert simhash(text or "") & (1 << 64) - 1 == plain(text)


@pytest.mark.parametrize("full", [512, 3])
def test_links_equal_all_pairs(spark, full):
    rng = random.Random(full)
    values = {rng.getrandbits(64) - (1 << 63) for _ in range(60)}
    for value in list(values)[:12]:
        for _ in range(25):
            near = value
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                near ^= -(1 << 63) if b == 63 else 1 << b
            values.add(near)
    swarm = rng.getrandbits(63)
    values |= {swarm ^ sum(1 << b for b in rng.sample([0, 1, 2, 3, 17, 33, 40, 50, 62], rng.randrange(5))) for _ in range(150)}
    values |= {0, -1, 1, -(1 << 63)}
    got = links(spark.createDataFrame([(v,) for v in values], "fp long"), full).collect()
    assert len(got) == len(set(got)) and {(r.a, r.b) for r in got} == brute_links(values)


def test_variants_are_not_broadcast(spark, tmp_path):
    rng = random.Random(7)
    values = {rng.getrandbits(62) for _ in range(40)}
    values |= {v ^ 5 << 40 for v in values}
    spark.createDataFrame([(v,) for v in values], "fp long").write.parquet(f"{tmp_path}/fp")
    for full in (512, 1):
        found = links(spark.read.parquet(f"{tmp_path}/fp"), full)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        # A list of full buckets is a table of known size and may be broadcast; nothing that was exploded may.
        joins = [line for line in plan.splitlines() if "Join" in line and "Anti" not in line and "Semi" not in line]
        assert joins and all("SortMergeJoin" in line for line in joins)
        assert {(r.a, r.b) for r in found.collect()} == brute_links(values)


def test_places_are_not_broadcast(spark, sf):
    docs = located(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    marked = near_duplicates(docs, place=("_file", "_at"))
    plan = marked._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert marked.where("kept").count() == marked.select("component_id").distinct().count() < docs.count()


def test_components_of_edge_cases(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(10, " ".join(base)), (9, " ".join(base).upper()), (11, " ".join([*base, "more"])), (12, " ".join(base[:399])), (3, "other text here")]
    rows += [(100 + i, t) for i, t in enumerate(TEXTS)] + [(3, "other text here"), (None, "other text here"), (None, "only null")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, fp int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()), key=repr)
    values = [plain(t) for _, t in rows]
    top = 1 << 62
    parts = brute_components([top if i is None else i for i, _ in rows], values)
    want = [(i, f"{v:016x}", None if c == top else c) for (i, _), v, c in zip(rows, values, parts, strict=True)]
    assert got == sorted(want, key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_whole_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    values = [plain(r.text) for r in docs]
    parts = brute_components([r.doc_id for r in docs], values)
    want = sorted((r.doc_id, f"{v:016x}", c) for r, v, c in zip(docs, values, parts, strict=True))
    assert sorted(map(tuple, op5_simhash(spark, sf).collect())) == want
