"""Data-quality pass: missing counts, z-score, describe, quantile bounds, winsorise, box-plot stats.

Every statistic is a distributed aggregate.  Fitted parameters (mean, std, bounds)
are single rows collected to the driver and applied as literals, so no 1-row frame
is cross-joined to the data and no whole-table window is used.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.clean import quote, winsorize as winsorize_expr
from cohortlens.operators.quantiles import exact_quantiles, exact_quantiles_wide


def _num(c: str):
    x = F.col(quote(c)).cast("double")
    return F.when(~F.isnan(x), x)


def _is_float(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes)[c] in ("double", "float")


def missing_report(df: DataFrame) -> DataFrame:
    """(variaveis, n): missing values per column (NULL, and NaN for floating columns)."""
    exprs = []
    for c in df.columns:
        miss = F.col(quote(c)).isNull()
        if _is_float(df, c):
            miss = miss | F.isnan(F.col(quote(c)))
        exprs.append(F.count(F.when(miss, F.lit(1))).alias(c))
    wide = df.agg(*exprs)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variaveis"), F.col(quote(c)).cast("long").alias("n")) for c in df.columns
    ])).alias("kv"))
    return stacked.select("kv.variaveis", "kv.n")


def _stack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("variavel"), _num(c).alias("valor")) for c in columns]))
    return df.select(kv.alias("kv")).select("kv.variavel", "kv.valor")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per column (long form)."""
    from cohortlens.session import cut_lineage

    # moments and quartiles are two passes: materialise the columns once
    st = _stack(cut_lineage(df.select(*[_num(c).alias(c) for c in columns]), "describe"), columns)
    moments = st.groupBy("variavel").agg(
        F.count("valor").alias("count"), F.avg("valor").alias("mean"), F.stddev_samp("valor").alias("std"),
        F.min("valor").alias("min"), F.max("valor").alias("max"))
    qs = exact_quantiles(st, "valor", [0.25, 0.5, 0.75], by=["variavel"], names=["p25", "p50", "p75"])
    return (moments.join(qs, on="variavel", how="left")
            .select("variavel", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def quantile_bounds(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.90) -> tuple[float, float]:
    """Driver pair (q_lo, q_hi) of one column (one scalar row collected)."""
    row = exact_quantiles(df, column, [lo, hi], names=["lo", "hi"]).first()
    return (None, None) if row is None else (row["lo"], row["hi"])


def quantile_bounds_frame(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.90) -> DataFrame:
    return exact_quantiles(df, column, [lo, hi], names=["q_lo", "q_hi"])


def winsorize(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.90,
              out: str | None = None) -> DataFrame:
    """Add ``out`` (default ``<column>_wins``): the column clipped to its [lo, hi] quantiles."""
    q_lo, q_hi = quantile_bounds(df, column, lo, hi)
    out = out or f"{column}_wins"
    return df.withColumn(out, winsorize_expr(_num(column), F.lit(q_lo).cast("double"), F.lit(q_hi).cast("double")))


def zscore(df: DataFrame, column: str, out: str = "valor_z") -> DataFrame:
    """(x - mean) / population std, NaN/NULL ignored in the statistics and kept in the output;
    a zero std divides by 1."""
    row = df.agg(F.avg(_num(column)).alias("m"), F.stddev_pop(_num(column)).alias("s")).first()
    m = row["m"]
    s = row["s"]
    if s is None or s == 0.0:
        s = 1.0
    return df.withColumn(out, (_num(column) - F.lit(m).cast("double")) / F.lit(float(s)))


def boxplot_stats(df: DataFrame, columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Box-plot statistics per column: quartiles, IQR, whisker ends (most extreme data within
    1.5 IQR of the box) and the number of points beyond them.

    The input is written once for the two passes; the quartiles (one row per column) are applied
    as literals in one global aggregate, so no data is shuffled by the column name."""
    from cohortlens.session import cut_lineage

    wide = cut_lineage(df.select(*[_num(c).alias(c) for c in columns]), "boxplot")
    qs = {r["variavel"]: r for r in exact_quantiles(_stack(wide, columns), "valor", [0.25, 0.5, 0.75], by=["variavel"],
                                                    names=["q1", "median", "q3"]).collect()}
    found = [c for c in columns if c in qs]
    if not found:
        return df.sparkSession.createDataFrame([], "variavel string, q1 double, median double, q3 double, iqr double, "
                                                   "whisker_lo double, whisker_hi double, n_outliers bigint")
    aggs, fixed = [], {}
    for i, c in enumerate(found):
        q1, med, q3 = (float(qs[c][k]) for k in ("q1", "median", "q3"))
        x, lo, hi = F.col(quote(c)), F.lit(q1 - whis * (q3 - q1)), F.lit(q3 + whis * (q3 - q1))
        fixed[c] = (q1, med, q3, q3 - q1)
        aggs.append(F.struct(F.min(F.when(x >= lo, x)).alias("whisker_lo"), F.max(F.when(x <= hi, x)).alias("whisker_hi"),
                             F.count(F.when((x < lo) | (x > hi), F.lit(1))).alias("n_outliers")).alias(f"s{i}"))
    one = wide.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("variavel"), *[F.lit(v).alias(n) for v, n in zip(fixed[c], ("q1", "median", "q3", "iqr"))],
                     *[F.col(f"s{i}.{n}").alias(n) for n in ("whisker_lo", "whisker_hi", "n_outliers")]) for i, c in enumerate(found)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quality_report(df: DataFrame, value_col: str, parser=None, lo: float = 0.05, hi: float = 0.90) -> DataFrame:
    """The quality pass of one money column: parse, z-score, winsorise, then describe
    the raw, z-scored and winsorised values side by side (long form)."""
    from cohortlens.session import cut_lineage

    # mean/std and bounds are two passes: parse once, materialise once
    x = cut_lineage(df.select((parser(F.col(quote(value_col))) if parser is not None else _num(value_col))
                              .alias(value_col)), "quality")
    x = zscore(x, value_col, "valor_z")
    x = winsorize(x, value_col, lo, hi, "valor_wins")
    return describe_numeric(x, [value_col, "valor_z", "valor_wins"])


__all__ = ["missing_report", "describe_numeric", "quantile_bounds", "quantile_bounds_frame", "winsorize",
           "zscore", "boxplot_stats", "quality_report", "exact_quantiles", "exact_quantiles_wide"]
