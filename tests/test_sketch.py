import numpy as np
import pytest

from cohortlens.operators import sketch


def _rank_error(values, v, prob):
    below, upto = (values < v).sum(), (values <= v).sum()
    want = prob * len(values)
    return max(below - want, want - upto, 0)


@pytest.mark.parametrize("points", [10, 50])
def test_rank_error_after_merging_days(spark, points):
    rng = np.random.default_rng(points)
    rows, held = [], {"a": [], "b": []}
    for day in range(9):
        for g in "ab":
            x = np.round(rng.lognormal(day / 3, 1, int(rng.integers(1, 300))), 1 if g == "b" else 9)
            held[g] += x.tolist()
            rows += [(g, day, float(v)) for v in x]
    rows += [("a", 3, None), ("b", 2, float("nan")), ("c", 1, None), (None, 1, 5.0)]
    df = spark.createDataFrame(rows, "g string, day int, v double").repartition(4)
    kept = sketch.summarise(df, "v", ["g", "day"], points)
    assert kept.groupBy("g", "day").count().where(f"count <> {points}").count() == 0
    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    for summary, times in ((kept, 1), (sketch.merge(kept, ["g"], points), 2)):
        got = sketch.estimate(summary, probs, ["g"]).collect()
        assert {r.g for r in got} == {"a", "b", None} and len(got) == 21
        for r in got:
            values = np.array(held.get(r.g, [5.0]))
            assert r.n == len(values)
            assert _rank_error(values, r.value, r.prob) <= times * len(values) / points + 9
    assert sketch.estimate(sketch.summarise(df.limit(0), "v", ["g"], points), probs, ["g"]).collect() == []


def test_without_groups(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    got = {r.prob: r.value for r in sketch.estimate(sketch.summarise(df, "v", [], 100), [0.5, 0.25], []).collect()}
    assert abs(got[0.5] - 500) <= 11 and abs(got[0.25] - 250) <= 11
