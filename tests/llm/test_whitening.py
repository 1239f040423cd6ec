import math

import numpy as np
import pytest

from cohortlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, Component int, n string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) * 0.3
    return [(i, [float(np.float32(x)) for x in r], 1, 2, "x") for i, r in enumerate(v)]


def expected(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    values, vecs = np.linalg.eigh(np.cov(x.T, bias=True))
    return ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ vecs[:, ::-1] / np.sqrt(values[::-1]), values[::-1] / values.sum()


@pytest.mark.parametrize("width", [3, 20, 61])
def test_bit_sliced_products_are_exact(width):
    rng = np.random.default_rng(width)
    z = rng.integers(-(1 << width), 1 << width, (333, 5))
    z[:, 3] = 7  # no bit plane at all
    sums, products = whitening._block(z)
    exact = z.astype(object)
    assert (products == exact.T @ exact).all() and list(sums) == list(exact.sum(axis=0))


def test_against_dense_arithmetic(spark, rows):
    got = whitening.digest(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    deviation, white, explained = expected([r[1] for r in rows])
    assert len(got) == len(rows) * 6 and {r.n for r in got} == {500}
    sign = {r.component: np.sign(r.whitened * white[0, r.component - 1]) for r in got if r.vec_id == 0}
    for r in got:
        assert r.deviation == deviation[r.vec_id] == int(r.deviation_exact)
        assert r.whitened == pytest.approx(sign[r.component] * white[r.vec_id, r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_odd_vectors_are_dropped_and_the_rest_unchanged(spark, rows):
    odd = [(None, rows[0][1], *rows[0][2:]), (3, rows[3][1], *rows[3][2:]), (600, None, 1, 2, "x"), (601, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 2, "x"),
           (602, [float("nan")] * 6, 1, 2, "x"), (603, [float("-inf"), *[0.0] * 5], 1, 2, "x"), (604, [], 1, 2, "x"), (605, [1.0] * 3, 1, 2, "x"), (606, [3e38] * 6, 1, 2, "x")]
    got = whitening.digest(spark.createDataFrame([*rows, *odd], SCHEMA).repartition(3)).collect()
    assert len(got) == 502 * 6 and {r.n for r in got} == {502}
    assert sum(r.vec_id is None for r in got) == 6 and sum(r.vec_id == 3 for r in got) == 12
    deviation = expected([r[1] for r in [*rows, *odd[:2]]])[0]
    assert {r.deviation for r in got if r.vec_id == 3} == {deviation[3]}


def test_dimensions_that_cannot_be_whitened(spark, rows):
    flat = [(r[0], [r[1][0], 5.0, 2 * 1.0, r[1][1]], *r[2:]) for r in rows]
    got = whitening.digest(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2} and sum({r.explained for r in got}) == pytest.approx(1)
    for few in (rows[:1], [], [(1, None, 1, 2, "x")], [(1, [], 1, 2, "x")]):
        empty = whitening.digest(spark.createDataFrame(few, SCHEMA))
        assert empty.collect() == [] and empty.columns == list(got[0].asDict())


def test_large_entries_keep_exact_deviations(spark):
    rows = [(i, [float((-1) ** i * (1 << 40) + i), float(i)], 1, 2, "x") for i in range(20)]
    got = whitening.digest(spark.createDataFrame([(a, [float(x) for x in b], *c) for a, b, *c in rows], SCHEMA.replace("float", "double"))).collect()
    x = [[64 * int(c) + 1_000_000 for c in r[1]] for r in rows]
    s = [sum(c) for c in zip(*x)]
    for r in got:
        want = sum((20 * a - b) ** 2 for a, b in zip(x[r.vec_id], s))
        assert int(r.deviation_exact) == want and r.deviation == (want if want < 1 << 63 else None)
