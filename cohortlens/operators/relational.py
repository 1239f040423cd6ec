"""Relational operators: key filters, best-row-per-key, look-back windows, unions, append guard.

Scale notes
-----------
* ``top1_per_key`` is written as a grouped ``max(struct(...))`` instead of a
  ``row_number`` window: the aggregate is partial (map-side combine), so a key
  holding a third of all rows is reduced to one row per input partition before
  the shuffle.  A ``row_number`` window would send every row of that key to one
  task.  ``rank_within_key`` (all ranks) is kept for callers that need them.
* Unions are narrow (no shuffle); ``union_distinct`` shuffles once on all columns.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.clean import quote, ts_lit


def _col(c) -> Column:
    return F.col(quote(c)) if isinstance(c, str) else c


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in cols])
    return df.filter(cond)


def exclude_keys(df: DataFrame, key: str, values: Iterable, not_null: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is not null and not in ``values`` (plus optional not-null columns)."""
    cond = _col(key).isNotNull() & ~_col(key).isin(list(values))
    for c in not_null:
        cond = cond & _col(c).isNotNull()
    return df.filter(cond)


def isolate_keys(df: DataFrame, key: str, values: Iterable, not_null: Sequence[str] = ()) -> DataFrame:
    """Complement of ``exclude_keys`` over the not-null rows."""
    cond = _col(key).isin(list(values))
    for c in not_null:
        cond = cond & _col(c).isNotNull()
    return df.filter(cond)


def _ordered_fields(df: DataFrame, key: str, order_by: Sequence[str]) -> list[str]:
    rest = [c for c in df.columns if c != key and c not in order_by]
    return list(order_by) + rest


def top1_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (descending, NULLs last),
    ties broken by the remaining columns in their order, also descending.

    Equal to ``row_number() OVER (PARTITION BY key ORDER BY o1 DESC NULLS LAST, ...,
    r1 DESC NULLS LAST, ...) = 1`` but computed as a partial aggregate.
    Rows with a NULL key are dropped (a NULL key has no customer).
    """
    fields = _ordered_fields(df, key, order_by)
    packed = F.struct(*[_col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    best = df.filter(_col(key).isNotNull()).groupBy(_col(key).alias(key)).agg(F.max(packed).alias("_best"))
    out = [F.col(quote(key))] + [F.col(f"_best.f{i}").alias(c) for i, c in enumerate(fields)]
    return best.select(*out).select(*df.columns)


def rank_within_key(df: DataFrame, key: str, order_by: Sequence[str], name: str = "rn",
                    skew_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """``row_number`` per key with the same total order as ``top1_per_key``.

    The plain form is one window partitioned by the key: every row of a key goes to
    one task.  With ``skew_safe`` a key may span many tasks:

    1. range-partition on (key, order columns) -- a hot key is split across ranges;
    2. the partition id is materialised once (reliable checkpoint, so the ranges stay
       fixed even if a stage is recomputed after an executor loss);
    3. rows are ranked locally per (partition, key) -- bounded by a partition;
    4. per-key offsets = rows of the same key in lower partitions (a frame with one
       row per (partition, key)), added to the local rank.
    """
    fields = _ordered_fields(df, key, order_by)
    order = [_col(c).desc_nulls_last() for c in fields]
    if not skew_safe:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(_col(key)).orderBy(*order)))
    from cohortlens.session import cut_lineage

    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, _col(key).asc_nulls_first(), *order)
                         .withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid", _col(key)).orderBy(*order)))
    counts = ranged.groupBy("_pid", _col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.sum("_n").over(Window.partitionBy("_k").orderBy("_pid")) - F.col("_n"))
    j = local.join(offsets, (local["_pid"] == offsets["_pid"]) & local[key].eqNullSafe(offsets["_k"]))
    return j.select(*[local[c] for c in df.columns], (offsets["_off"] + local["_lrn"]).alias(name))


def lookback_bounds(as_of, months: int = 12) -> tuple[Column, Column]:
    """Closed window [as_of - months, as_of] at midnight, as TIMESTAMP_NTZ columns."""
    end = as_of if isinstance(as_of, Column) else ts_lit(as_of)
    start = F.add_months(end.cast("date"), -months).cast("timestamp_ntz")
    return start, end


def lookback_filter(df: DataFrame, ts_col: str, as_of, months: int = 12) -> DataFrame:
    start, end = lookback_bounds(as_of, months)
    t = _col(ts_col)
    return df.filter((t >= start) & (t <= end))


def union_many(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name of any number of inputs (narrow, no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_many(frames).distinct()


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def append_guard(new_rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new_rows`` whose key is not yet in ``existing`` (idempotent append).

    A row without a key can't be told from one already loaded, so it is left out; of rows that are equal in
    all columns one is kept.  Rows that differ under one key are all new."""
    keys = existing.select(_col(key).alias(key)).distinct()
    return filter_not_null(new_rows, key).distinct().join(keys, on=key, how="left_anti")


OUTCOMES = ("new", "changed", "unchanged", "gone")


def row_fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of the values of a row: equal for equal values, NULL told from empty text."""
    values = F.to_json(F.struct(*[_col(c).alias(str(i)) for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    return F.md5(values)


def keyed_merge(current: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A repeatable load: every key with its ``outcome`` and its row after the load.

    ``new`` and ``changed`` rows have the incoming values, ``unchanged`` and ``gone`` ones those that are there; ``columns`` (default: all but the key) are compared by a
    fingerprint.  Rows without a key are left out; of rows with one key the one with the largest fingerprint counts, so a load
    can be repeated with the same result.  Loading the result without ``gone`` rows again leaves everything unchanged."""
    names = list(columns) if columns is not None else [c for c in incoming.columns if c != key]

    def side(df: DataFrame, mark: str) -> DataFrame:
        row = F.struct(row_fingerprint(names).alias("fp"), *[_col(c).alias(c) for c in names])
        rows = df.where(_col(key).isNotNull()).select(_col(key).alias(key), row.alias("row"))
        return rows.groupBy(_col(key)).agg(F.max_by("row", "row.fp").alias(mark))

    both = side(current, "had").join(side(incoming, "has"), key, "full_outer")
    had, has = F.col("had"), F.col("has")
    outcome = (F.when(had.isNull(), "new").when(has.isNull(), "gone").when(F.col("had.fp") == F.col("has.fp"), "unchanged").otherwise("changed"))
    row = F.when(outcome.isin("new", "changed"), has).otherwise(had)
    return both.select(_col(key), outcome.alias("outcome"), row.alias("row")).select(_col(key), "outcome", *[F.col("row").getField(c).alias(c) for c in names])


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
