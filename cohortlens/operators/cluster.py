"""Clustering: quality indices, model choice, K-Means and Gaussian-mixture sweeps, labels, cluster profile and a 2-D view.

Scale notes
-----------
* ``vector_metrics_row`` scores one given labelling from per-cluster sufficient statistics (count, sum vector, sum of squared norms): one
  aggregate pass for the statistics and one scoring pass, O(n k d).  Its silhouette is the squared-Euclidean one (the definition of Spark's ``ClusteringEvaluator``).
* The Euclidean silhouette, which the original's threshold of 0.20 belongs to, is ``fused.silhouettes``: exact, at the square of the number of distinct vectors.
  ``choose_model`` and the K-Means sweep take the metric as a parameter; with ``silhouette_squared`` everything is linear.
* Sweeps fit all k at once (``operators.fused``): one aggregate a round for all models.
* The driver holds only sums, centres and covariances; k is what the caller asked the sweep for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.clean import quote
from cohortlens.operators import fused
from cohortlens.operators.quantiles import exact_quantiles
from cohortlens.session import cut_lineage


# ---------------------------------------------------------------------------
# Indices from sufficient statistics
# ---------------------------------------------------------------------------
def vector_metrics_row(pred: DataFrame, features: str = "features", prediction: str = "cluster",
                       d: int | None = None) -> dict:
    """silhouette_squared, davies_bouldin and calinski_harabasz of the labelling of a vector column,
    in two passes: one statistics aggregate (count, sum vector, sum of squared norms per
    label) and one scoring aggregate whose per-row work is O(k d) array arithmetic with a
    fixed-size expression (the k centroids are one literal array), whatever k is."""
    arr = vector_to_array(F.col(features))
    if d is None:
        d = len(pred.select(features).first()[0])
    norm2 = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v * v)
    rows = (pred.groupBy(F.col(prediction).alias("lab"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(norm2).alias("sq"),
                 *[F.sum(arr[i]).alias(f"s{i}") for i in range(d)])
            .collect())   # one row per cluster
    labels = sorted(r["lab"] for r in rows)
    by = {r["lab"]: r for r in rows}
    n = {c: by[c]["n"] for c in labels}
    cent = {c: [by[c][f"s{i}"] / n[c] for i in range(d)] for c in labels}
    k = len(labels)
    n_total = sum(n.values())
    if k < 2:
        return {"k": k, "silhouette_squared": 0.0, "davies_bouldin": 0.0, "calinski_harabasz": 1.0}

    idx = F.create_map(*[x for j, c in enumerate(labels) for x in (F.lit(c), F.lit(j))])
    own = F.element_at(idx, F.col(prediction))                       # 0-based label index
    cents = F.array(*[F.array(*[F.lit(v) for v in cent[c]]) for c in labels])
    q = F.array(*[F.lit(by[c]["sq"] / n[c]) for c in labels])
    ns = F.array(*[F.lit(float(n[c])) for c in labels])
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)
    # mean squared distance to the members of each cluster: |x|^2 + Q_c/n_c - 2 x.mu_c
    avg = F.zip_with(F.transform(cents, lambda m: dot(arr, m)), q, lambda dt, qq: norm2 + qq - F.lit(2.0) * dt)
    scored = pred.select(F.col(prediction).alias("lab"), own.alias("o"), arr.alias("x"), avg.alias("avg"))
    n_own = F.element_at(ns, F.col("o") + 1)
    a = F.element_at(F.col("avg"), F.col("o") + 1) * n_own / (n_own - F.lit(1.0))
    b = F.array_min(F.filter(F.col("avg"), lambda v, i: i != F.col("o")))
    sil = (F.when(n_own <= 1, F.lit(0.0)).when(a < b, F.lit(1.0) - a / b)
           .when(a > b, b / a - F.lit(1.0)).otherwise(F.lit(0.0)))
    mu = F.element_at(cents, F.col("o") + 1)
    d2 = F.aggregate(F.zip_with(F.col("x"), mu, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda acc, t: acc + t)
    out = (scored.groupBy("lab").agg(F.sum(sil).alias("sil"), F.sum(F.sqrt(d2)).alias("dist"),
                                      F.sum(d2).alias("w")).collect())
    agg = {r["lab"]: r for r in out}

    silhouette = sum(agg[c]["sil"] for c in labels) / n_total
    scatter = {c: agg[c]["dist"] / n[c] for c in labels}
    scores = []
    for i in labels:
        best = 0.0
        for j in labels:
            if i != j:
                m = math.dist(cent[i], cent[j])
                best = max(best, (scatter[i] + scatter[j]) / m if m > 0 else 0.0)
        scores.append(best)
    db = sum(scores) / k
    overall = [sum(by[c][f"s{i}"] for c in labels) / n_total for i in range(d)]
    between = sum(n[c] * sum((u - v) ** 2 for u, v in zip(cent[c], overall)) for c in labels)
    within = sum(agg[c]["w"] for c in labels)
    ch = (between / (k - 1)) / (within / (n_total - k)) if within > 0 else 1.0
    return {"k": k, "silhouette_squared": silhouette, "davies_bouldin": db, "calinski_harabasz": ch}


METRICS_SCHEMA = "k int, silhouette_squared double, davies_bouldin double, calinski_harabasz double"


def labelled_metrics(df: DataFrame, cols: Sequence[str], label: str) -> dict:
    """``vector_metrics_row`` for a labelling of plain columns; rows without a label are left out."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(
        df.filter(F.col(quote(label)).isNotNull()).select(*[F.col(quote(c)).cast("double").alias(c) for c in cols],
                                                          F.col(quote(label)).alias("cluster")))
    return vector_metrics_row(vec, "features", "cluster", d=len(cols))


def assign_nearest(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Label every row with its nearest centroid (squared Euclidean distance, ties to the smaller label)."""
    x = [F.col(quote(c)).cast("double") for c in cols]
    d2 = F.array(*[sum((xi - F.lit(float(m))) * (xi - F.lit(float(m))) for xi, m in zip(x, c)) for c in centroids])
    return df.withColumn(out, (F.array_position(d2, F.array_min(d2)) - 1).cast("int"))


# ---------------------------------------------------------------------------
# Model choice
# ---------------------------------------------------------------------------
def select_k(metrics: DataFrame, metric: str = "silhouette_squared") -> DataFrame:
    """Best K-Means k: highest silhouette (``metric`` names the column), then lowest Davies-Bouldin, then first k."""
    return metrics.orderBy(F.desc(metric), F.asc("davies_bouldin"), F.asc("k")).limit(1)


def select_k_bic(metrics: DataFrame) -> DataFrame:
    """Best mixture k: lowest BIC, then first k."""
    return metrics.orderBy(F.asc("bic"), F.asc("k")).limit(1)


def gmm_bic(log_likelihood: float, n: int, k: int, d: int) -> float:
    """BIC of a full-covariance mixture: -2 logL + p ln n, p = (k-1) + k d + k d (d+1) / 2."""
    p = (k - 1) + k * d + k * d * (d + 1) / 2.0
    return -2.0 * log_likelihood + p * math.log(n)


def mixture_log_likelihood(df: DataFrame, cols: Sequence[str], weights: Sequence[float], means: Sequence[Sequence[float]],
                           covariances: Sequence[Sequence[Sequence[float]]]) -> tuple[int, float]:
    """(rows, log-likelihood) of a Gaussian mixture with given parameters, one aggregate."""
    import numpy as np

    x = [F.col(quote(c)).cast("double") for c in cols]
    terms = []
    for w, m, cov in zip(weights, means, covariances):
        precision = np.linalg.inv(np.asarray(cov, float))
        d = [xi - F.lit(float(mi)) for xi, mi in zip(x, m)]
        form = sum((d[i] * d[j] * F.lit(float(precision[i][j])) for i in range(len(d)) for j in range(len(d)) if precision[i][j]), F.lit(0.0))
        constant = math.log(w) - 0.5 * (len(d) * math.log(2 * math.pi) + float(np.linalg.slogdet(np.asarray(cov, float))[1]))
        terms.append(F.lit(constant) - F.lit(0.5) * form)
    top = F.greatest(*terms) if len(terms) > 1 else terms[0]
    logp = top + F.log(sum((F.exp(t - top) for t in terms), F.lit(0.0)))
    r = df.agg(F.count(logp).alias("n"), F.sum(logp).alias("ll")).first()
    return r["n"], r["ll"]


def choose_model(best_kmeans: dict, best_gmm: dict | None, metric: str, threshold: float) -> str:
    """'GMM' when the best K-Means value of ``metric`` is below the threshold (and a mixture exists).

    The threshold belongs to the metric, so there is no default for either."""
    if best_gmm is not None and best_kmeans[metric] < threshold:
        return "GMM"
    return "KMeans"


# ---------------------------------------------------------------------------
# Fitting
# ---------------------------------------------------------------------------
def canonical(df: DataFrame, id_col: str, partitions: int) -> DataFrame:
    """The frame written in ``partitions`` hash partitions of the id, each sorted by id."""
    return cut_lineage(df.repartition(partitions, F.col(quote(id_col))).sortWithinPartitions(quote(id_col)), row_group=fused.ROW_GROUP)


@dataclass
class SweepResult:
    metrics: DataFrame
    best_k: int | None
    best: dict | None
    model: object
    labels: DataFrame | None      # id, carried columns, cluster (mixtures: and probability)
    centres: dict | None = None   # of the K-Means fits by k
    rows: DataFrame | None = None     # fused.vectors and fused.blocks of the sweep
    blocks: DataFrame | None = None


SWEEP_SCHEMA = "k int, silhouette double, silhouette_squared double, davies_bouldin double, calinski_harabasz double"


def kmeans_sweep(df: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int] = range(2, 10), seed: int = 42, max_iter: int = 300,
                 tol: float = 1e-4, carry: Sequence[str] = (), metric: str = "silhouette") -> SweepResult:
    """Fit K-Means for every k at once, score each labelling, keep the best (``metric`` desc, Davies-Bouldin asc, k asc).

    ``metric`` is ``silhouette`` (Euclidean; its cost is the square of the distinct vectors) or ``silhouette_squared`` (linear; ``silhouette`` is then null)."""
    rows = fused.vectors(df, id_col, cols, carry)
    starts = fused.race_starts(rows, id_col, max(ks), seed)
    if not len(starts):
        return SweepResult(df.sparkSession.createDataFrame([], SWEEP_SCHEMA), None, None, None, None)
    blocks = fused.blocks(rows)
    centres = fused.lloyd(blocks, {k: starts[:k] for k in ks}, max_iter, tol)
    scored = fused.indices(blocks, centres)
    euclidean = {}
    if metric == "silhouette":
        euclidean = fused.silhouettes(fused.distinct(blocks, centres), [f"k{k}" for k in ks], w="w")
    table = [{**scored[k], "silhouette": euclidean.get(f"k{k}")} for k in ks]
    best = min(table, key=lambda m: (-m[metric], m["davies_bouldin"], m["k"]))
    names = [c.split()[0] for c in SWEEP_SCHEMA.split(", ")]
    metrics = df.sparkSession.createDataFrame([tuple(m[c] for c in names) for m in table], SWEEP_SCHEMA)
    model = fused.KMeansFit(centres[best["k"]])
    labels = rows.select(quote(id_col), *[quote(c) for c in carry], model.label(F.col("x")).alias("cluster"))
    return SweepResult(metrics, best["k"], best, model, labels, centres, rows, blocks)


def gmm_sweep(df: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int] = range(2, 10), seed: int = 42, tol: float = 1e-3,
              max_iter: int = 100, floor: float = 1e-6, carry: Sequence[str] = (), centres: dict | None = None, kmeans: SweepResult | None = None) -> SweepResult:
    """Fit full-covariance Gaussian mixtures for every k at once, from the clusters of K-Means ``centres`` (None: fitted here); keep the lowest BIC.

    ``kmeans`` is the K-Means sweep of the same frame, columns and carried columns, whose vectors and centres are taken over (None: they are made here).

    ``floor`` is added to the variances in every step, so that columns with few values (one-hot) leave no covariance singular;
    ``tol`` is the gain of the mean log-likelihood that ends a fit, as in the original library."""
    if kmeans is not None and kmeans.rows is not None:
        rows, blocks, centres = kmeans.rows, kmeans.blocks, kmeans.centres if centres is None else centres
    else:
        rows = fused.vectors(df, id_col, cols, carry)
        blocks = fused.blocks(rows)
    if centres is None:
        starts = fused.race_starts(rows, id_col, max(ks), seed)
        centres = fused.lloyd(blocks, {k: starts[:k] for k in ks}, 300, 1e-4) if len(starts) else {}
    if not centres:
        return SweepResult(df.sparkSession.createDataFrame([], "k int, bic double"), None, None, None, None)
    n, models, seen = fused.em(blocks, fused.mixtures_from_centres(blocks, {k: centres[k] for k in ks}, floor), max_iter, tol, floor)
    table = [{"k": k, "bic": gmm_bic(seen[k][-1], n, k, len(cols))} for k in ks]
    best = min(table, key=lambda m: (m["bic"], m["k"]))
    metrics = df.sparkSession.createDataFrame([(m["k"], m["bic"]) for m in table], "k int, bic double")
    labels = fused.mixture_labels(rows, models[best["k"]], F.col("x")).drop("x")
    return SweepResult(metrics, best["k"], best, models[best["k"]], labels)


# ---------------------------------------------------------------------------
# Profile and 2-D view
# ---------------------------------------------------------------------------
PROFILE_MEDIANS = ["tempo_vida_anos", "qt_contratos_12m", "valor_contratado_12m", "produtos_distintos_12m"]


def cluster_profile(df: DataFrame, cluster: str = "cluster",
                    medians: Sequence[str] = PROFILE_MEDIANS,
                    max_col: str = "periodicidade_max_meses_12m",
                    pct_cols: Sequence[str] = ("fechou_>=1ano_12m", "multi_produto_total")) -> DataFrame:
    """Size, medians, a maximum and two percentages per cluster, largest cluster first.

    Aggregated on the label column of the labelled rows themselves (no join back by
    id, so a repeated id cannot multiply rows)."""
    base = df.groupBy(F.col(quote(cluster)).alias("cluster")).agg(
        F.count(F.lit(1)).alias("clientes"),
        F.max(F.col(quote(max_col))).alias(f"{max_col}_max"),
        *[(F.lit(100.0) * F.avg(F.col(quote(c)).cast("int").cast("double"))).alias(f"pct_{c}") for c in pct_cols])
    stacked = df.select(F.col(quote(cluster)).alias("cluster"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variavel"), F.col(quote(c)).cast("double").alias("valor")) for c in medians
    ])).alias("kv")).select("cluster", "kv.variavel", "kv.valor")
    med = exact_quantiles(stacked, "valor", [0.5], by=["cluster", "variavel"], names=["median"])
    wide = med.groupBy("cluster").agg(*[F.max(F.when(F.col("variavel") == c, F.col("median"))).alias(f"{c}_median")
                                        for c in medians])
    out = base.join(wide, on="cluster", how="left")
    cols = (["cluster", "clientes"] + [f"{c}_median" for c in medians] + [f"{max_col}_max"]
            + [f"pct_{c}" for c in pct_cols])
    return out.select(*[quote(c) for c in cols]).orderBy(F.desc("clientes"), F.asc("cluster"))


def pca_2d(vec_df: DataFrame, features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Two principal coordinates of mean-centred features; each component's sign is fixed
    so that its largest-magnitude loading is positive."""
    return coordinates(cut_lineage(vec_df.select(*[quote(k) for k in keep], vector_to_array(F.col(features)).alias("x"))), 2, keep)


def coordinates(rows: DataFrame, count: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``pca_1`` ... ``pca_count`` (None: all) of the array column ``x``."""
    first = rows.select("x").first()
    d = len(first["x"]) if first else 0
    fit = fused.principal_components(rows, d)
    found = fit.coordinates(F.col("x"), min(d, count or d))
    return rows.select(*[quote(k) for k in keep], *[c.alias(f"pca_{j}") for j, c in enumerate(found, 1)])
