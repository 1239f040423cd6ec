import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm import runs


def brute(word, least):
    """(start, length, period) of all runs, by start and period."""
    n, found = len(word), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def random_texts(rng, letters):
    out = []
    for _ in range(rng.randrange(1, 6)):
        n = rng.randrange(0, 90)
        word = [rng.randrange(letters) for _ in range(n)]
        if n > 10:
            p, s = rng.randrange(1, 9), rng.randrange(n // 2)
            for k in range(s + p, min(n, s + p * rng.randrange(2, 9))):
                word[k] = word[k - p]
        out.append(word)
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
@pytest.mark.parametrize("grid", [40, 1 << 20])
def test_all_runs_of_random_words(letters, grid, monkeypatch):
    monkeypatch.setattr(runs, "GRID", grid)
    rng = random.Random(letters)
    for least in (2, 4, 12) * 12:
        texts = random_texts(rng, letters)
        got = runs.find(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts], np.int64), least)
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in brute(t, least)]


def test_extensions_against_word_by_word():
    rng = np.random.default_rng(3)
    word = np.append(np.tile(rng.integers(0, 3, 37), 5)[:160], 99)
    ext = runs.Extensions(word)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(161), np.arange(161)))
    i, j = i[i != j], j[i != j]
    want = [next(k for k in range(162) if max(a, b) + k > 160 or word[a + k] != word[b + k]) for a, b in zip(i.tolist(), j.tolist())]
    assert ext(i, j).tolist() == want


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w, 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n_},{q}\n" for s, n_, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_digest_against_brute_force(spark, prose):
    rng = random.Random(1)
    docs = list(prose)
    for k in range(60):  # repetition beside the tails that ids make
        part = [f"p{rng.randrange(9)}" for _ in range(rng.randrange(1, 12))]
        docs.append((1000 + k, f"é {' '.join(part * rng.randrange(1, 7))}\n\t{' '.join(part[: len(part) // 2])} end"))
    got = runs.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(expected(*d) for d in docs)


def test_odd_rows(spark, odd):
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    got = sorted(map(tuple, runs.digest(odd).collect()), key=key)
    short = [r for r in got if r[0] != 5]
    assert short == sorted((expected(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 5), key=key)
    assert sum(r[0] == 5 for r in got) == 1 and all(r[6] and r[7] for r in got)
    assert runs.digest(odd.limit(0)).collect() == []


def test_long_periodic_text():
    sizes = np.array([60_000], np.int64)
    got = runs.find(np.arange(60_000) % 7000, sizes)
    assert [tuple(r) for r in got.tolist()] == [(0, 0, 60_000, 7000)]
    got = runs.find(np.zeros(3000, np.int64), np.array([3000], np.int64))
    assert [tuple(r) for r in got.tolist()] == [(0, 0, 3000, 1)]
