import re

import numpy as np
import pytest
import xxhash

from cohortlens.llm import simhash


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_groups(fps, radius):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_against_brute_force(prose, prose_docs):
    got = {r.doc_id: r for r in simhash.digest(prose_docs).collect()}
    fps = [brute_fingerprint(t) for _, t in prose]
    label = brute_groups(fps, 2)
    assert len(got) == len(prose)
    for (i, _), f, g in zip(prose, fps, label):
        assert got[i].fingerprint == f"{f:016x}"
        assert got[i].component_id == g


def test_fingerprint_is_the_spark_hash(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert simhash.fingerprint(b"a B c") == row.h & (1 << 64) - 1


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_forest_finds_all_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    centre = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([centre ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) for _ in range(12)] + [centre]))
    shard = np.sort(rng.integers(0, 3, len(values)))
    forest = simhash.Forest(values, shard)
    root = np.array([forest.root[s] for s in shard.tolist()])
    who, node = forest.search(values, root, radius)
    got = set(zip(who.tolist(), node.tolist()))
    want = {(i, j) for i in range(len(values)) for j in range(len(values))
            if shard[i] == shard[j] and int(values[i] ^ values[j]).bit_count() <= radius}
    assert got == want


def test_large_shards_are_cut_into_trees_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST", 5)
    monkeypatch.setattr(simhash, "FOREST", 50)
    rng = np.random.default_rng(3)
    fps = sorted({int(np.int64(sum(1 << int(b) for b in rng.integers(0, 9, 4)))) for _ in range(60)})
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    label = brute_groups(fps, 2)
    groups = {}
    for f, g in zip(fps, label):
        groups.setdefault(g, set()).add(f)
    found = {}
    for f in fps:
        found.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_a_long_chain(spark):
    n = 70
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame([(i, i + 1) for i in range(n)] + [(200, 300)], "a long, b long")).collect()}
    assert all(got.get(i, 0) == 0 for i in range(n + 1))
    assert got[300] == 200


def test_odd_rows(odd):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.digest(odd).collect()))
    zero = "0" * 16
    by_id = {g[1]: g[2:] for g in got if not g[0]}
    assert len(got) == 10
    assert by_id[2] == by_id[3] == by_id[4] == (zero, 2)
    assert by_id[6][1] == 1 and by_id[1][1] == 1
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 5, 7, 8]
    assert simhash.digest(odd.limit(0)).collect() == [] and simhash.keep_one(odd.limit(0)).collect() == []


def test_an_id_on_several_rows_keeps_the_row_that_stands_for_its_group(spark):
    rows = [(1, "one two three four five"), (2, "one two three four five"), (2, "a text that nobody else has"), (3, "third text, alone"), (3, "third text, alone"),
            (4, "one two three four five"), (4, "one two three four five")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, rows[0][1]), (2, rows[2][1]), (3, rows[3][1])]
