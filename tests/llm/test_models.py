"""Quality rules, quality classifier and license scan."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import licenses, quality_classifier, quality_rules
from cohortlens.llm.textmodel import HashedText


@pytest.fixture(scope="module")
def graded(spark):
    """Texts of three kinds and labels for most of them."""
    rng = random.Random(6)
    words = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(rng.randrange(60, 120))]
        kind = i % 4
        if kind == 0:
            w = [x + rng.choice(["***", "$$$"]) for x in w]
        if kind == 1:
            for _ in range(12):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "Moron,", "scum"])
        docs.append((i, " ".join(w)))
        if i % 5:
            labels.append((i, int(kind != 0), int(kind == 1)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_judged_right(graded):
    docs, labels = graded
    kept = {r.doc_id: r.kept for r in quality_classifier.digest(docs, labels).collect()}
    held = [i for i in range(400) if i % 5 == 0]
    assert np.mean([kept[i] == (i % 4 > 1) for i in held]) >= 0.9
    rules = {r.doc_id: r for r in quality_rules.digest(docs, labels).collect()}
    assert np.mean([rules[i].kept == (i % 4 != 0) for i in held]) >= 0.9
    probs = [rules[i].quality_prob for i in held]
    assert min(probs) < 0.3 and max(probs) > 0.7 and not any(r.base_failed for r in rules.values())


def test_models_do_not_depend_on_the_partitioning(graded):
    docs, labels = graded
    a = quality_classifier.fit(docs, quality_classifier.grades_of(labels), max_rows=100)
    b = quality_classifier.fit(docs.repartition(7), quality_classifier.grades_of(labels.repartition(5)), max_rows=100)
    assert np.allclose(a.weight, b.weight) and np.allclose(a.thresholds, b.thresholds)
    assert (np.diff(a.thresholds) > 0).all()


def test_gradient_of_the_ordinal_likelihood():
    y = np.array([0, 1, 2, 1, 2])
    score, free = np.array([-1.0, 0.3, 2.0, 0.1, -0.5]), np.array([-0.4, 0.2])

    def likelihood(score, free):
        cut = free[0] + np.array([0.0, np.exp(free[1])])
        up = np.concatenate([np.ones((5, 1)), 1 / (1 + np.exp(-(score[:, None] - cut))), np.zeros((5, 1))], axis=1)
        return np.log(up[np.arange(5), y] - up[np.arange(5), y + 1])

    by_score, by_free = quality_classifier.ordinal_slope(score, free, y)
    e = 1e-6
    assert np.allclose(by_score, (likelihood(score + e, free) - likelihood(score - e, free)) / (2 * e), atol=1e-5)
    for k in range(2):
        d = np.eye(2)[k] * e
        assert np.isclose(by_free[k], ((likelihood(score, free + d) - likelihood(score, free - d)) / (2 * e)).mean(), atol=1e-5)


def test_hashed_features_do_not_depend_on_what_came_before():
    texts = [b"a b a  c", b"", b"Idiot, idiot!", b"\xc3\xa9t\xc3\xa9 x"]
    one, two = HashedText(), HashedText()
    two([b"other words x a", b"b"])
    for a, b in zip(one(texts), two(texts)):
        assert np.array_equal(a, b)


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_counts(spark, odd, prose, prose_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    texts = dict(prose)
    for r in quality_rules.digest(prose_docs, none).collect():
        want = base(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    rows = quality_rules.digest(odd, none).collect()
    assert len(rows) == 10 and [tuple(r[c] for c in quality_rules.COUNTS) for r in rows if r.doc_id == 2] == [(0, 0, 0, 0, 0)]
    assert [r.n_dup_lines for r in rows if r.doc_id == 8] == [2]
    assert quality_rules.digest(odd.limit(0), none).collect() == []


@pytest.mark.parametrize("big", [False, True])
def test_repeated_words(big):
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 50, 200):
        code = rng.integers(0, 6, n)
        text = " ".join(map(str, code))
        assert quality_rules.repeated(code + (1 << 40) * big if n else code) == base(text)[4]


def test_classifier_odd_rows(spark, odd, graded):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (5, 1, 0), (6, 1, 1), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(odd, quality_classifier.grades_of(labels))
    out = quality_classifier.judge(odd, model)
    assert out.count() == 10 and out.columns.count("tail_prob") == 1
    assert quality_classifier.select_documents(odd, model).columns == odd.columns
    none = quality_classifier.fit(odd, quality_classifier.grades_of(labels.limit(0)))
    assert none is None and quality_classifier.select_documents(odd, none).count() == 10
    assert quality_classifier.digest(odd.limit(0), labels).collect() == []


def test_licenses_are_found_whole_edited_and_twice(spark):
    notice = licenses.TEMPLATES["MIT-notice"]
    words = notice.split()
    rows = [(1, "Some text.\nReleased under the MIT License."), (2, "Licensed under the APACHE license; version 2.0 -- and so on"), (3, " ".join(words[:20] + ["odd"] + words[21:40] + words[42:])),
            (4, "the license of this work is nobody's"), (5, "Released under the MIT License. x y z Released under the MIT License."), (6, None), (7, ""), (8, "MIT"), (9, " ".join(words[:30]))]
    got = sorted((r.doc_id, r.license, round(r.coverage, 2), r.start_word, r.end_word) for r in licenses.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = len(words)
    assert got == [(1, "MIT", 1.0, 2, 7), (2, "Apache-2.0", 1.0, 0, 7), (3, "MIT-notice", round((n - 3) / n, 2), 0, n - 2), (5, "MIT", 1.0, 0, 5), (5, "MIT", 1.0, 8, 13)]
    assert licenses.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def lcs(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b, 1):
            q.append(p[j - 1] + 1 if x == y else max(p[j], q[-1]))
        p = q
    return p[-1]


def test_alignment_and_winnowing():
    rng = np.random.default_rng(2)
    for _ in range(60):
        template = rng.integers(1, 9, rng.integers(4, 30)).astype(np.uint64)
        keep = np.ones(len(template), bool)
        keep[rng.choice(len(template), rng.integers(0, min(licenses.BAND, len(template) // 5) + 1), replace=False)] = False  # as many as the band allows
        text = np.concatenate([rng.integers(1, 9, 10).astype(np.uint64), template[keep], rng.integers(1, 9, 10).astype(np.uint64)])
        matched, first, last = licenses.align(template, text, 10)
        assert keep.sum() <= matched <= lcs(template.tolist(), text.tolist())
        assert 0 <= first < last <= len(text)
    text = rng.integers(1, 1000, 300).astype(np.uint64)
    run = text[50 : 50 + licenses.GRAM + licenses.WINDOW - 1]
    assert set(licenses.winnow(np.r_[rng.integers(1, 1000, 9).astype(np.uint64), run])[1]) & set(licenses.winnow(text)[1])


def test_one_changed_word_of_a_template_is_found():
    """Each word of each template replaced, left out, or one put before it: the index leads to what a full alignment covers."""
    index = licenses.Index(licenses.TEMPLATES)
    rng = np.random.default_rng(4)
    other = lambda n: rng.integers(1, 1000, n).astype(np.uint64)
    for t, words in enumerate(index.words):
        n = len(words)
        for at in range(n) if n < 60 else range(0, n, n // 3) if n < 1000 else [n // 2][: n < 2000]:
            for new in (np.r_[words[:at], other(1), words[at + 1 :]], np.r_[words[:at], words[at + 1 :]], np.r_[words[:at], other(1), words[at:]]):
                text = np.r_[other(9), new.astype(np.uint64), other(9)]
                full = lcs(words.tolist(), text.tolist()) if len(words) < 40 else len(words) - 1
                if full >= licenses.LEAST * len(words):
                    assert max((licenses.align(words, text, s)[0] for u, s in index.candidates(text) if u == t), default=0) >= full, (index.names[t], at)


def test_short_licenses_with_changed_words(spark):
    rows = [(1, "Released with the MIT License."), (2, "Released under MIT License."), (3, "Released under the terms of the MIT License"), (4, "Licensed under the CC BY-NC 4.0.")]
    got = {r.doc_id: (r.license, r.coverage) for r in licenses.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", 0.8), 2: ("MIT", 0.8), 3: ("MIT", 1.0), 4: ("CC-BY-NC-4.0", 1.0)}


def test_related_licenses_are_told_apart(spark):
    """Each whole template, and whole texts of one family: one report, that of the right license."""
    names = sorted(licenses.TEMPLATES)
    rows = [(i, "Some words before.\n" + licenses.TEMPLATES[n] + "\nand after") for i, n in enumerate(names)]
    got = [(r.doc_id, r.license, r.coverage) for r in licenses.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).orderBy("doc_id", "start_word").collect()]
    assert got == [(i, n, 1.0) for i, n in enumerate(names)]
    assert {f"BSD-{k}-Clause-text" for k in (2, 3, 4)} | {"Apache-1.1-text", "GPL-2.0-notice", "LGPL-2.1-notice", "AGPL-3.0-notice", "GPL-3-body"} <= set(names)


def test_a_first_sentence_is_no_license(spark):
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
           "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    assert licenses.digest(spark.createDataFrame([(1, bsd), (2, gpl)], "doc_id long, text string")).collect() == []


def test_license_odd_rows(odd):
    assert licenses.digest(odd).collect() == [] and licenses.digest(odd.limit(0)).collect() == []
