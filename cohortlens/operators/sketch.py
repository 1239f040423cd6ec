"""Mergeable quantile summaries: kept by day or part, merged later, with a stated rank error.

A summary of a group has ``points`` rows (value, weight): the quantiles at (i + 1/2) / points, each standing for n / points rows.  Summaries of parts are
merged by putting their rows together; an estimate takes the smallest value whose summed weight reaches the wanted share.  The rank of an estimate is off
by at most n / points (half a point's rows of every part, and the width of one point), plus one row a part for the interpolation.  ``merge`` brings the rows of a
group back to ``points`` and may add n / points again.

The exact operator computes the quantiles, so no task meets all rows of a group; summaries are small (points rows a group and part).
NULL and NaN values are ignored; groups without values have no summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.clean import quote
from cohortlens.operators.quantiles import exact_quantiles
from cohortlens.session import cut_lineage


def summarise(df: DataFrame, value: str, by: Sequence[str], points: int = 100) -> DataFrame:
    """(*by, point, value, weight) of every group."""
    x = F.col(quote(value)).cast("double")
    rows = cut_lineage(df.select(*[F.col(quote(b)).alias(b) for b in by], x.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value")), "summary")
    names = [f"p{i}" for i in range(points)]
    found = exact_quantiles(rows, "value", [(i + 0.5) / points for i in range(points)], by=by, names=names)
    count = rows.groupBy(*[F.col(quote(b)).alias(f"_{b}") for b in by]).agg(F.count(F.lit(1)).alias("n"))
    joined = found.join(count, [F.col(quote(b)).eqNullSafe(F.col(quote(f"_{b}"))) for b in by]) if by else found.crossJoin(count)  # one row each
    out = joined.select(*[quote(b) for b in by], "n", F.posexplode(F.array(*names)).alias("point", "value")).where("value IS NOT NULL")
    return out.select(*[quote(b) for b in by], "point", "value", (F.col("n") / F.lit(float(points))).alias("weight"))


def _cumulated(summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """The points of each group by value, with the weight up to each and in all: (points of the parts) rows a group."""
    group = Window.partitionBy(*[F.col(quote(b)) for b in by])
    run = group.orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    once = summary.groupBy(*[F.col(quote(b)).alias(b) for b in by], "value").agg(F.sum("weight").alias("weight"))
    return once.select("*", F.sum("weight").over(run).alias("upto"), F.sum("weight").over(group).alias("total"))


def merge(summary: DataFrame, by: Sequence[str], points: int = 100) -> DataFrame:
    """Summaries of parts as one summary of ``points`` rows for each group."""
    target = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    aims = summary.groupBy(*[F.col(quote(b)).alias(b) for b in by]).agg(F.sum("weight").alias("n")).select("*", target.alias("point"))
    rows = aims.select(*[quote(b) for b in by], "point", "n", ((F.col("point") + 0.5) / points).alias("prob"))
    got = _reached(summary, rows, by)
    return got.select(*[quote(b) for b in by], "point", "value", (F.col("n") / F.lit(float(points))).alias("weight"))


def _reached(summary: DataFrame, aims: DataFrame, by: Sequence[str]) -> DataFrame:
    """``aims`` (*by, prob, ...) with the smallest value whose share of the weight reaches prob."""
    cum = _cumulated(summary, by).select(*[F.col(quote(b)).alias(f"_{b}") for b in by], "value", "upto", "total")
    on = [F.col(quote(b)).eqNullSafe(F.col(quote(f"_{b}"))) for b in by]
    # a tolerance for sums of fractions that should meet the share exactly
    reach = F.col("upto") >= F.col("prob") * F.col("total") * F.lit(1 - 1e-12)
    met = aims.join(cum, [*on, reach]) if by else aims.join(cum, reach)
    return met.groupBy(*[F.col(quote(c)).alias(c) for c in aims.columns]).agg(F.min("value").alias("value"))


def estimate(summary: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(*by, n, prob, value) from the summaries of any number of parts."""
    n = summary.groupBy(*[F.col(quote(b)).alias(b) for b in by]).agg(F.round(F.sum("weight")).cast("long").alias("n"))
    return _reached(summary, n.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")), by)
