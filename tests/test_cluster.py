import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from pyspark.sql import functions as F

from cohortlens.operators import cluster as K
from cohortlens.operators import fused


def _brute(x, lab):
    labels = sorted(set(lab))
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in labels if c != lab[i])
        s.append((b - a) / max(a, b) if a != b else 0.0)
    cent = {c: x[lab == c].mean(0) for c in labels}
    scat = {c: np.linalg.norm(x[lab == c] - cent[c], axis=1).mean() for c in labels}
    db = np.mean([max((scat[i] + scat[j]) / np.linalg.norm(cent[i] - cent[j]) for j in labels if j != i)
                  for i in labels])
    mu = x.mean(0)
    B = sum((lab == c).sum() * ((cent[c] - mu) ** 2).sum() for c in labels)
    W = sum(((x[lab == c] - cent[c]) ** 2).sum() for c in labels)
    ch = (B / (len(labels) - 1)) / (W / (len(x) - len(labels)))
    return np.mean(s), db, ch


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), rng.normal(-4, 0.5, (25, 3)),
                        np.array([[9.0, 9.0, 9.0]])])
    lab = np.array([0] * 40 + [1] * 30 + [2] * 25 + [3])
    rows = [(i, int(lab[i]), *map(float, x[i])) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id int, cluster int, a double, b double, c double")
    return df, x, lab


def test_indices_match_brute_force(spark, labelled):
    df, x, lab = labelled
    sil, db, ch = _brute(x, lab)
    r = K.labelled_metrics(df, ["a", "b", "c"], "cluster")
    assert np.isclose(r["silhouette_squared"], sil, rtol=1e-9)
    assert np.isclose(r["davies_bouldin"], db, rtol=1e-9)
    assert np.isclose(r["calinski_harabasz"], ch, rtol=1e-9)


def test_vector_path_and_spark_evaluator_agree(spark, labelled):
    df, x, lab = labelled
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    r1 = K.labelled_metrics(df, ["a", "b", "c"], "cluster")
    r2 = K.vector_metrics_row(vec, "features", "cluster", d=3)
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                             distanceMeasure="squaredEuclidean").evaluate(vec)
    for key in ("silhouette_squared", "davies_bouldin", "calinski_harabasz"):
        assert np.isclose(r1[key], r2[key], rtol=1e-9)
    assert np.isclose(r1["silhouette_squared"], ev, rtol=1e-9)


def test_selection_rules(spark):
    m = spark.createDataFrame([(2, 0.5, 1.0, 1.0), (3, 0.6, 0.9, 1.0), (4, 0.6, 0.8, 1.0), (5, 0.6, 0.8, 2.0)],
                              K.METRICS_SCHEMA)
    assert K.select_k(m).first()["k"] == 4
    b = spark.createDataFrame([(2, 10.0), (3, 5.0), (4, 5.0)], "k int, bic double")
    assert K.select_k_bic(b).first()["k"] == 3
    assert K.choose_model({"m": 0.1}, {"bic": 1.0}, "m", 0.2) == "GMM"
    assert K.choose_model({"m": 0.3}, {"bic": 1.0}, "m", 0.2) == "KMeans"
    assert K.choose_model({"m": 0.1}, None, "m", 0.2) == "KMeans"
    assert np.isclose(K.gmm_bic(-100.0, 50, 2, 3), 200.0 + (1 + 6 + 12) * np.log(50))


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0], [6, 6], [0, 8]])
    x = np.concatenate([rng.normal(c, 0.6, (60, 2)) for c in centres])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id int, x1 double, x2 double")


def test_kmeans_sweep_recovers_planted_blobs(spark, blobs):
    m = K.canonical(blobs, "id", 4)
    res = K.kmeans_sweep(m, "id", ["x1", "x2"], ks=range(2, 6), seed=42)
    assert res.best_k == 3
    labels = res.labels.collect()
    assert len(labels) == 180 and len({r["id"] for r in labels}) == 180
    sizes = sorted(np.bincount([r["cluster"] for r in labels]))
    assert sizes == [60, 60, 60]
    assert res.metrics.count() == 4


def test_fit_independent_of_input_partitioning(spark, blobs):
    centres = []
    for parts in (1, 7):
        r = K.kmeans_sweep(blobs.repartition(parts), "id", ["x1", "x2"], ks=[3], seed=42)
        centres.append(sorted(tuple(np.round(c, 9)) for c in r.model.clusterCenters()))
    assert centres[0] == centres[1]


def _points(df):
    rows = sorted(df.collect())
    return np.array([[r.x1, r.x2] for r in rows])


def test_fused_lloyd_against_separate_fits(spark, blobs):
    x, rows = _points(blobs), fused.vectors(blobs, "id", ["x1", "x2"])
    starts = fused.race_starts(rows, "id", 5, 1)
    assert len({tuple(s) for s in starts}) == 5 and all((x == s).all(axis=1).any() for s in starts)
    got = fused.lloyd(rows, {k: starts[:k] for k in (2, 3, 5)}, 50, 0.0)
    for k in (2, 3, 5):
        c = starts[:k].copy()
        for _ in range(50):
            lab = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
            c = np.array([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(k)])
        assert np.allclose(got[k], c, atol=1e-9)
    ind = fused.indices(rows, got)
    for k in (2, 3, 5):
        lab = ((x[:, None] - got[k]) ** 2).sum(-1).argmin(1)
        want = _brute(x, lab)
        assert np.allclose([ind[k]["silhouette_squared"], ind[k]["davies_bouldin"], ind[k]["calinski_harabasz"]], want)


def test_a_round_is_one_job_for_all_k(spark, blobs):
    rows = fused.vectors(blobs, "id", ["x1", "x2"])
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("lloyd", "")
    try:
        starts = np.array([[0.0, 0.0], [6.0, 6.0], [0.0, 8.0], [3.0, 3.0]])
        fused.lloyd(rows, {k: starts[:k] for k in (2, 3, 4)}, 1, 0.0)
        before = len(tracker.getJobIdsForGroup("lloyd"))
        fused.lloyd(rows, {2: starts[:2]}, 1, 0.0)
        assert len(tracker.getJobIdsForGroup("lloyd")) == 2 * before  # as many for three models as for one
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_few_distinct_vectors(spark):
    df = spark.createDataFrame([(i, float(i % 3), 1.0) for i in range(30)], "id int, x1 double, x2 double")
    r = K.kmeans_sweep(df, "id", ["x1", "x2"], ks=range(2, 6))
    assert {m.k: m.silhouette for m in r.metrics.collect()}[3] == 1.0 and r.best_k == 3
    g = K.gmm_sweep(df, "id", ["x1", "x2"], ks=[2, 3])  # singular without a floor
    assert all(np.isfinite(m.bic) for m in g.metrics.collect()) and g.labels.count() == 30
    assert K.kmeans_sweep(df.limit(0), "id", ["x1", "x2"]).best_k is None and K.gmm_sweep(df.limit(0), "id", ["x1", "x2"]).best_k is None
    one = K.kmeans_sweep(df.where("id % 3 = 0"), "id", ["x1", "x2"], ks=[2])  # one distinct vector
    assert one.best["silhouette"] == 0.0


def _euclidean(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        others = [d[i, lab == c].mean() for c in set(lab.tolist()) if c != lab[i]]
        if own.sum() == 1 or not others:
            out.append(0.0)
            continue
        a, b = d[i, own].sum() / (own.sum() - 1), min(others)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("block", [7, 2048])
def test_euclidean_silhouette_against_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(fused, "BLOCK", block)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 2, (90, 3)), 0)  # many equal vectors
    labels = {"a": rng.integers(0, 3, 90), "b": (x[:, 0] > 0).astype(int), "c": np.r_[np.zeros(89, int), 1], "d": np.zeros(90, int)}
    df = spark.createDataFrame([(list(map(float, x[i])), *(int(labels[c][i]) for c in "abcd"), None if i % 9 == 0 else int(labels["a"][i])) for i in range(90)],
                               "x array<double>, a int, b int, c int, d int, e int").repartition(3)
    got = fused.silhouettes(df, list("abcde"))
    for c in "abcd":
        assert np.isclose(got[c], _euclidean(x, labels[c]), atol=1e-12)
    some = np.arange(90) % 9 != 0
    assert np.isclose(got["e"], _euclidean(x[some], labels["a"][some]), atol=1e-12)
    assert fused.silhouettes(df.limit(0), ["a"]) == {"a": 0.0}


@pytest.mark.parametrize("name", ["silhouette", "choose_model"])
def test_queries_of_the_silhouette_read_the_features_once(spark, name, monkeypatch):
    from cohortlens.plans import queries as Q
    from cohortlens.plans.registry import REGISTRY

    made = []

    def features(session, sf_dir):
        made.append(sf_dir)
        return session.createDataFrame([(0.5 + i % 3, i % 12, i % 4, i % 2) for i in range(60)], "tempo_vida_anos double, qt_contratos_12m long, produtos_distintos_12m long, periodicidade_max_meses_12m int")

    monkeypatch.setattr(Q, "features_frame", features)
    assert REGISTRY[name].fn(spark, "nowhere").count() == 1
    assert made == ["nowhere"]


def test_euclidean_silhouette_by_few_bounded_tasks(spark, monkeypatch):
    """The tasks and the shuffled sums do not grow with the square of the blocks: 60 blocks were dealt to 3600 tasks."""
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(fused, "BLOCK", 8)
    counts, deal = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, n, *cols: counts.append(n) or deal(self, n, *cols))
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (240, 2)), rng.normal(1e6, 1e-3, (240, 2))])  # tight and far apart: products would cancel
    a, b = np.arange(480) % 3, np.arange(480) // 160
    df = spark.createDataFrame([([float(v) for v in r], int(i), str(j), None if i else 1) for r, i, j in zip(x, a, b)], "x array<double>, a int, b string, c int")
    got = fused.silhouettes(df, ["a", "b", "c"])
    assert np.isclose(got["a"], _euclidean(x, a), atol=1e-9) and np.isclose(got["b"], _euclidean(x, b), atol=1e-9) and got["c"] == 0.0
    assert max(counts) <= 144


def test_em_likelihood_never_falls_and_labels_are_responsibilities(spark, blobs):
    x, rows = _points(blobs), fused.vectors(blobs, "id", ["x1", "x2"])
    starts = fused.race_starts(rows, "id", 4, 7)
    models = fused.mixtures_from_centres(rows, {k: starts[:k] for k in (2, 3, 4)}, 1e-6)
    n, fitted, seen = fused.em(rows, models, 20, 0.0, 1e-6)
    assert n == 180 and all(len(v) == 21 for v in seen.values())
    assert all(b >= a - 1e-3 for v in seen.values() for a, b in zip(v, v[1:]))
    m = fitted[3]
    dens = np.stack([w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(c), x - mu)) / (2 * np.pi * np.sqrt(np.linalg.det(c)))
                     for w, mu, c in zip(m.weights, m.means, m.covariances)], axis=1)
    assert np.isclose(seen[3][-1], np.log(dens.sum(1)).sum())
    got = sorted(fused.mixture_labels(rows, m, F.col("x")).drop("x").collect())
    assert [r.cluster for r in got] == dens.argmax(1).tolist()
    assert np.allclose([r.probability for r in got], dens.max(1) / dens.sum(1))


def test_gmm_sweep_keeps_the_lowest_bic(spark, blobs):
    res = K.gmm_sweep(blobs, "id", ["x1", "x2"], ks=range(2, 5), seed=42)
    bics = {r["k"]: r["bic"] for r in res.metrics.collect()}
    assert res.best_k == min(bics, key=lambda k: (bics[k], k)) == 3
    assert res.labels.count() == 180 and set(res.labels.columns) == {"id", "cluster", "probability"}


@pytest.mark.parametrize("d", [1, 2, 12])
def test_jacobi_against_eigh(d):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, d))
    a = a @ a.T
    a[:, 0] = a[0, :] = 0  # a column without variance
    values, vecs = fused.jacobi(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1]) and np.allclose(vecs @ np.diag(values) @ vecs.T, a) and np.allclose(vecs.T @ vecs, np.eye(d))


def test_profile_and_pca(spark, labelled):
    df, x, lab = labelled
    feats = df.selectExpr("id", "cluster", "a AS tempo_vida_anos", "b AS qt_contratos_12m",
                          "c AS valor_contratado_12m", "a AS produtos_distintos_12m",
                          "CAST(cluster * 3 AS INT) AS periodicidade_max_meses_12m",
                          "b > 0 AS `fechou_>=1ano_12m`", "c > 0 AS multi_produto_total")
    prof = K.cluster_profile(feats, "cluster").collect()
    assert [r["clientes"] for r in prof] == [40, 30, 25, 1]
    c0 = [r for r in prof if r["cluster"] == 0][0]
    assert np.isclose(c0["tempo_vida_anos_median"], np.median(x[lab == 0, 0]))
    assert np.isclose(c0["pct_multi_produto_total"], 100 * (x[lab == 0, 2] > 0).mean())
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    coords = K.pca_2d(vec, "features", keep=["id"]).collect()
    p = np.array([[r["pca_1"], r["pca_2"]] for r in coords])
    assert abs(p[:, 0].mean()) < 1e-9 and abs(np.corrcoef(p.T)[0, 1]) < 1e-6
    assert p[:, 0].var() >= p[:, 1].var()


def test_segment_customers_end_to_end(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from cohortlens.plans.jobs import segment_customers

    rng = np.random.default_rng(9)
    rows = []
    for i in range(240):
        g = i % 3
        rows.append((f"c{i}", dt.datetime(2020, 1, 1), ["A", "B", "C"][g], float(1 + 5 * g + rng.random()),
                     int(2 + 10 * g + rng.integers(0, 3)), float(1000 * (1 + g) + rng.random()), int(1 + g),
                     [1, 6, 12][g], g == 2, g > 0))
    feats = spark.createDataFrame(rows, "cd_cliente string, dt_abertura timestamp_ntz, vl_faixa_faturamento string, "
                                        "tempo_vida_anos double, qt_contratos_12m long, valor_contratado_12m double, "
                                        "produtos_distintos_12m long, periodicidade_max_meses_12m int, "
                                        "`fechou_>=1ano_12m` boolean, multi_produto_total boolean")
    res = segment_customers(feats, 3, "silhouette_squared", 0.2, ks=range(2, 5))
    labels = res.labels.collect()
    assert len(labels) == 240 and len({r["cd_cliente"] for r in labels}) == 240
    prof = res.profile.collect()
    sizes = [r["clientes"] for r in prof]
    assert sum(sizes) == 240 and sizes == sorted(sizes, reverse=True)
    assert [r["cluster"] for r in prof] == list(range(len(prof)))   # relabelled by size
    with pytest.raises(ValueError):
        segment_customers(feats.unionByName(feats.limit(1)), 3, "silhouette_squared", 0.2, ks=range(2, 3))
    assert feats.select(F.count("*")).first()[0] == 240


FIT = """
import json, sys
sys.path.insert(0, {root!r})
import numpy as np
from cohortlens.session import local_session
from cohortlens.operators import cluster as K
spark = local_session({cpus}, shuffle_partitions={cpus})
rng = np.random.default_rng(5)
rows = [(int(i), float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 4, (600, 2)))]
df = spark.createDataFrame(rows, "id int, x1 double, x2 double").repartition({cpus} * 3)
r = K.kmeans_sweep(K.canonical(df, "id", 6), "id", ["x1", "x2"], ks=[6], seed=42)
print("CENTRES", json.dumps(sorted(c.tolist() for c in r.model.clusterCenters())))
spark.stop()
"""


def test_centres_do_not_depend_on_the_cores():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for cpus in (2, 8):
        out = subprocess.run([sys.executable, "-c", FIT.format(root=root, cpus=cpus)], capture_output=True, text=True, timeout=300)
        line = [x for x in out.stdout.splitlines() if x.startswith("CENTRES")]
        assert line, out.stderr[-2000:]
        found.append(np.array(json.loads(line[0][8:])))
    assert np.abs(found[0] - found[1]).max() < 1e-9


def test_mixture_likelihood_and_nearest_centroid(spark, blobs):
    x = np.array([[r.x1, r.x2] for r in blobs.collect()])
    parts = [(0.3, (0.0, 0.0), ((1.0, 0.2), (0.2, 2.0))), (0.7, (5.0, 5.0), ((9.0, 0.0), (0.0, 4.0)))]
    dens = sum(w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) / (2 * np.pi * np.sqrt(np.linalg.det(c))) for w, m, c in parts)
    n, ll = K.mixture_log_likelihood(blobs, ["x1", "x2"], *zip(*parts))
    assert n == 180 and np.isclose(ll, np.log(dens).sum(), rtol=1e-9)
    cents = [(0.0, 0.0), (6.0, 6.0), (0.0, 8.0)]
    got = {r.id: r.cluster for r in K.assign_nearest(blobs, ["x1", "x2"], cents).collect()}
    want = np.argmin(((x[:, None, :] - np.array(cents)) ** 2).sum(-1), axis=1)
    assert [got[i] for i in range(180)] == want.tolist()


def _repeated():
    rng = np.random.default_rng(12)
    x = np.round(np.concatenate([rng.normal(c, 1, (70, 3)) for c in (0, 5, 9)]), 1) + 1e3
    return np.concatenate([x, x[:90], x[:40]])


def test_rounds_over_packed_distinct_vectors(spark, monkeypatch):
    """Sums over distinct vectors with counts are those over all rows."""
    monkeypatch.setattr(fused, "PACKED", 500)  # several blocks in a task
    x = _repeated()
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double").repartition(3)
    rows = fused.vectors(df, "id", ["a", "b", "c"])
    packed = fused.blocks(rows)
    counts = [w for r in packed.collect() for w in np.frombuffer(r.w, "<f8")]
    assert len(counts) == len(np.unique(x, axis=0)) and sum(counts) == len(x) and packed.count() > 4
    starts = fused.race_starts(rows, "id", 4, 3)
    one, two = (fused.lloyd(t, {k: starts[:k] for k in (2, 4)}, 6, 0.0) for t in (rows, packed))
    assert all(np.allclose(one[k], two[k], rtol=1e-12) for k in one)
    assert all(np.allclose(list(a.values()), list(b.values()), rtol=1e-9) for a, b in zip(fused.indices(rows, one).values(), fused.indices(packed, one).values()))
    for table in (rows, packed):
        models = fused.mixtures_from_centres(table, one, 1e-6)
        n, fitted, seen = fused.em(table, models, 1, 0.0, 1e-6)
        assert n == len(x)
        for k in (2, 4):
            lab = ((x[:, None] - one[k]) ** 2).sum(-1).argmin(1)
            m = models[k]
            assert np.allclose(m.weights, np.bincount(lab, minlength=k) / len(x)) and np.allclose(m.means, [x[lab == j].mean(0) for j in range(k)], rtol=1e-12)
            assert np.allclose(m.covariances, [np.cov(x[lab == j].T, bias=True) + 1e-6 * np.eye(3) for j in range(k)], atol=1e-8)
            dens = np.stack([w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(c), x - mu)) / np.sqrt((2 * np.pi) ** 3 * np.linalg.det(c))
                             for w, mu, c in zip(m.weights, m.means, m.covariances)], axis=1)
            r = dens / dens.sum(axis=1, keepdims=True)
            assert np.isclose(seen[k][0], np.log(dens.sum(1)).sum(), rtol=1e-9)
            assert np.allclose(fitted[k].means, (r.T @ x) / r.sum(axis=0)[:, None], rtol=1e-9)
            want = [(r[:, j, None, None] * ((x - fitted[k].means[j])[:, :, None] * (x - fitted[k].means[j])[:, None, :])).sum(0) / r[:, j].sum() + 1e-6 * np.eye(3) for j in range(k)]
            assert np.allclose(fitted[k].covariances, want, atol=1e-7)


def test_nearest_centre_of_rows_between_centres():
    """Ties go to the first centre, and products that cancel decide nothing."""
    far = 1e7
    x = np.array([[far + v, -far] for v in (0.0, 0.5, 1.0, 1.5, 2.0, 1.0 + 1e-7, 1.0 - 1e-7)])
    sets = [np.array([[far, -far], [far + 2, -far], [far + 1, -far]]), np.array([[far, -far], [far + 2, -far]]), np.array([[far + 2, -far], [far, -far]])]
    a, b, c = fused._labels(x, sets)
    assert a.tolist() == [0, 0, 2, 1, 1, 2, 2] and b.tolist() == [0, 0, 0, 1, 1, 1, 0] and c.tolist() == [1, 1, 0, 0, 0, 0, 1]


@pytest.mark.parametrize("part", [3, 384])
def test_euclidean_silhouette_of_counted_rows(spark, part, monkeypatch):
    """Rows that come with counts; columns that don't vary within a block, near vectors far from zero, tiles of a block."""
    monkeypatch.setattr(fused, "PART", part)
    monkeypatch.setattr(fused, "BLOCK", 16)
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 2, 120), np.full(120, 0.1), rng.normal(1e4, 0.3, 120), rng.integers(0, 3, 120)]).astype(float)
    w, lab = rng.integers(1, 5, 120), rng.integers(0, 3, 120)
    df = spark.createDataFrame([(list(map(float, r)), int(n), int(k)) for r, n, k in zip(x, w, lab)], "x array<double>, w long, k int").repartition(3)
    assert np.isclose(fused.silhouettes(df, ["k"], w="w")["k"], _euclidean(np.repeat(x, w, axis=0), np.repeat(lab, w)), atol=1e-10)


def test_segment_customers_writes_its_vectors_once(spark, monkeypatch):
    """Both sweeps read the same packed vectors (before, each wrote its own), and a table of vectors has row groups for many tasks."""
    import pyarrow.parquet as pq

    from cohortlens.plans.jobs import CARRIED, segment_customers

    made, old = [], fused.vectors
    monkeypatch.setattr(fused, "vectors", lambda *a: made.append(old(*a)) or made[-1])
    monkeypatch.setattr(fused, "ROW_GROUP", 10_000)
    rng = np.random.default_rng(2)
    rows = [(i, "AB"[i % 2], float(1 + 3 * (i % 3) + rng.random()), int(i % 3), float(100 * (i % 3) + rng.random()), int(i % 3), 1 + i % 12, i % 4 == 0, i % 3 > 0) for i in range(3000)]
    feats = spark.createDataFrame(rows, f"cd_cliente long, vl_faixa_faturamento string, {CARRIED[0]} double, {CARRIED[1]} long, {CARRIED[2]} double, {CARRIED[3]} long, "
                                        f"{CARRIED[4]} int, `{CARRIED[5]}` boolean, {CARRIED[6]} boolean")
    res = segment_customers(feats, 1, "silhouette_squared", 2.0, ks=range(2, 4), max_iter=3)
    assert res.algorithm == "GMM" and sum(r.clientes for r in res.profile.collect()) == 3000 and len(made) == 1
    files = [f.removeprefix("file:") for f in made[0].inputFiles()]
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) > 3
    again = K.gmm_sweep(res.matrix, "cd_cliente", res.feature_cols, range(2, 4), centres=res.kmeans.centres)
    assert len(made) == 2 and np.allclose([r.bic for r in again.metrics.collect()], [r.bic for r in res.gmm.metrics.collect()], rtol=1e-9)
