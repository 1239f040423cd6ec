import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import common, jaccard


def sets_of(texts):
    out = []
    for t in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        out.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    return out


def brute(docs):
    sets, label, holders = sets_of(t for _, t in docs), list(range(len(docs))), {}
    for i, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, s in enumerate(sets):
        for j, k in Counter(j for shingle in s for j in holders[shingle] if j < i).items():
            if 100 * k >= 85 * (len(s) + len(sets[j]) - k):
                label[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[root(i)] = min(d, ids.get(root(i), d))
    return [(d, len(sets[i]), ids.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def corpus(seed):
    """Random texts, edited copies, a large group of near copies and a passage in many texts, on the edge of the similarity."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(800)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs = [words(rng.randrange(0, 120)) for _ in range(120)]
    for _ in range(200):
        d = list(rng.choice(docs))
        for _ in range(rng.randrange(0, 4)):
            if d:
                d[rng.randrange(len(d))] = rng.choice(vocabulary)
        docs.append(d + words(rng.randrange(0, 6)))
    base, passage = words(100), words(50)
    for _ in range(150):
        d = list(base)
        for _ in range(rng.randrange(1, 4)):
            d[rng.randrange(len(d))] = rng.choice(vocabulary)
        docs.append(d)
    docs += [words(rng.randrange(0, 30)) + passage + words(rng.randrange(0, 30)) for _ in range(150)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def found(spark, docs):
    return sorted(map(tuple, jaccard.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()))


def test_components_against_brute_force(spark):
    docs = corpus(1)
    want = sorted(brute(docs))
    assert len({w[2] for w in want}) < len(docs) - 100  # there are groups
    assert found(spark, docs) == want


def test_small_trees_and_shuffled_joins_give_the_same(spark, monkeypatch):
    for name, value in {"MOST": 40, "MOST_IN_RUN": 20, "FOREST": 300, "MOST_NODES": 0, "MOST_KEYS": 0, "MOST_SHINGLES": 0, "MOST_POINTS": 0}.items():
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(common, "MOST_NAMED", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    docs = corpus(2) + [(10_000 + i, "the same few words") for i in range(5)]
    assert found(spark, docs) == sorted(brute(docs))


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_tree_loses_no_pair(percent):
    rng = np.random.default_rng(percent)
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[a : a + 60], 40)) for a in rng.integers(0, 300, 150)]
    sets += [np.unique(np.r_[s[:-2], rng.choice(pool, 2)]) for s in sets]
    points, sizes = np.stack([jaccard._point(s) for s in sets]), np.array([len(s) for s in sets])
    query, point, common_ = jaccard.Tree(points, sizes).search(points, sizes, percent)
    got = dict(zip(zip(query.tolist(), point.tolist()), common_.tolist()))
    assert len(got) == len(query) < len(sets) ** 2
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if jaccard._linked(a, b, percent):
                assert got[i, j] >= len(np.intersect1d(a, b))


def test_second_search_takes_only_the_groups_that_are_apart(spark):
    nodes = spark.createDataFrame([(i, bytes([i])) for i in range(8)], "node long, shingles binary")
    root = spark.createDataFrame([(1, 0), (2, 0), (4, 3), (6, 5)], "node long, root long")
    groups = spark.createDataFrame([(0,), (3,), (7,)], "group long")
    got = sorted((r["node"], bytes(r["shingles"]), r["group"]) for r in jaccard._of_groups(nodes, root, groups).collect())
    assert got == [(i, bytes([i]), g) for i, g in [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (7, 7)]]


def test_odd_rows(spark, odd):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, jaccard.digest(odd).collect()), key=key) == sorted(brute(docs), key=key)
    assert jaccard.digest(odd.limit(0)).collect() == []
    lone = [(None, "a b c d e"), (None, "A b c d e"), (7, None), (8, " ")]
    assert sorted(map(tuple, jaccard.digest(spark.createDataFrame(lone, "doc_id long, text string")).collect()), key=key) == sorted(brute(lone), key=key)


def test_points_take_half_a_byte_for_each_coordinate():
    rng = np.random.default_rng(3)
    points = [rng.integers(0, top, jaccard.GROUPS).astype(np.uint32) for top in (1, 2, 16, 17, 256, 257, 70_000, 16)]
    points += [np.full(jaccard.GROUPS, top, np.uint32) for top in (15, 16, 255, 256, 1 << 20)]
    raw = [jaccard._packed(p) for p in points]
    assert np.array_equal(jaccard._unpacked(raw), np.stack(points)) and jaccard._unpacked([]).shape == (0, jaccard.GROUPS)
    assert [len(r) for r in raw[-5:]] == [jaccard.GROUPS // 2, jaccard.GROUPS, jaccard.GROUPS, 4 * jaccard.GROUPS, 4 * jaccard.GROUPS]


def test_sets_reach_python_in_small_batches(spark, monkeypatch):
    """A batch of sets has about a megabyte, whatever the number of rows; the session's settings are as before."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(str(rng.randrange(10**6)) for _ in range(2000))) for i in range(400)], "doc_id long, text string").coalesce(1)
    seen, buckets = [], jaccard.frequent_buckets

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["bytes"])

    def watched(nodes):
        seen.extend(r[0] for r in nodes.select("shingles").coalesce(1).mapInArrow(sizes, "bytes long").collect())
        return buckets(nodes)

    monkeypatch.setattr(jaccard, "frequent_buckets", watched)
    before = spark.conf.getAll
    assert jaccard.jaccard_components(docs).count() == 400
    assert sum(seen) > 6_000_000 and max(seen) < 1_200_000 and spark.conf.getAll == before
