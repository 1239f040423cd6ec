"""Mixing sources to target weights by systematic sampling.

A source's documents are put in the order of their size (then doc_id and checksum) and share its target evenly, so each has
the same expected number of copies e = target / source size.  The running sum of e in that order, plus one random offset of the source, crosses
an integer boundary now and then; a document is emitted once for each boundary it crosses.  In order of size, neighbours
in the sum are alike, so the words taken come within about one large document of the target.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the mix; a target stops at
``most`` times the size of its source and what is over is shared again by weight.

Defined results: null and empty texts have size 0 and count as rows; a source without any word has target 0 and is not
taken; repeated rows are rows of their own; the offset depends on ``seed`` and the source's name only, so reruns agree;
an empty table gives an empty table; other columns pass through, but for those that have the name of a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, fresh, named, ordered, row_of, small, task_of

#: Rows of (partition, source) that may be broadcast; more are joined by a shuffle on both.
MOST_PARTS = 200_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    The level of words for each unit of weight is found over the sources in order of the ratio at which they reach their limit:
    it is the level at the first source that does not.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights)) + 1)
    rows = sizes.select("source", "source_size", weight.alias("w"))
    by_limit = Window.orderBy((F.lit(float(most)) * F.col("source_size") / F.col("w")), F.col("source").asc_nulls_last())
    earlier, every = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.select(
        "*", (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))).alias("left"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(earlier), F.lit(0))).alias("weight_left"),
        F.row_number().over(by_limit).alias("nth"))
    level = F.col("left").cast("double") / F.col("weight_left")
    fits = level * F.col("w") <= F.lit(float(most)) * F.col("source_size")
    rows = rows.withColumn("level", F.min_by(F.when(fits, level), F.when(fits, F.col("nth"))).over(every))
    return rows.select("source", "source_size", F.least(F.col("w") * F.col("level"), F.lit(float(most)) * F.col("source_size")).alias("target"))


def mix(docs: DataFrame, *, source: str = "source", text: str = "text", doc_id: str = "doc_id",
        weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7, drop_text: bool = False,
        names: tuple[str, str, str, str] = ("size", "source_size", "target", "copies")) -> DataFrame:
    """All columns of ``docs`` (but the text, if ``drop_text``) with size, source_size, target and copies."""
    size, tie, at, src = fresh(docs, "__size", "__tie", "__at", "__source")
    body = F.col(f"`{text}`").cast("string")
    sized = docs.withColumns({size: n_words(body), tie: F.xxhash64(body), src: F.col(f"`{source}`").cast("string")})
    sized = sized.drop(text) if drop_text else sized
    rows = ordered(sized, [F.col(src).asc_nulls_last(), F.col(size), F.col(f"`{doc_id}`"), F.col(tie)], at, "mix-rows")
    # a row for each partition and source: the hot source has its partitions, none has more rows than a partition
    parts = rows.groupBy(task_of(at).alias("task"), F.col(src).alias("source")).agg(
        F.min(row_of(at)).alias("first"), F.count("*").alias("n"), F.sum(size).alias("words"))
    aim = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("\u0000")))), 1, 4), 16, 10)
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    each, zero, rank, crossed = fresh(rows, "__each", "__offset", "__rank", "__crossed")
    aim = aim.select(F.col("source").alias("s"), "source_size", "target",
                     F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(each))
    parts = parts.withColumn(rank, F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    key, other, total, goal = fresh(rows, "__task", "__other", "__total", "__goal")
    parts = parts.join(aim, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("task").alias(key), F.col("source").alias(other), F.col("source_size").alias(total), F.col("target").alias(goal),
        each, rank, (offset.cast("double") / 65536).alias(zero))
    joined = rows.join(small(parts, MOST_PARTS, "mix-parts"), (task_of(at) == F.col(key)) & F.col(src).eqNullSafe(F.col(other)))
    nth = F.col(rank) + row_of(at)  # documents of the source before this one
    passed = lambda k: F.floor(F.col(zero) + k * F.col(each))
    copies = F.least(passed(nth + 1) - passed(nth), F.ceil(F.col(each))).cast("int")
    out = joined.withColumn(crossed, copies).drop(tie, at, src, key, other, each, rank, zero)
    return named(out, dict(zip((size, total, goal, crossed), names)))


def emit(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as ``mix`` says, with the columns of ``docs`` only."""
    names = fresh(docs, "__size", "__source_size", "__target", "__copies", "__again")
    mixed = mix(docs, names=tuple(names[:4]), **options)
    mixed = mixed.where(F.col(names[3]) > 0)
    return mixed.withColumn(names[4], F.explode(F.sequence(F.lit(1), F.col(names[3])))).select([F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    mixed = mix(docs.select("doc_id", "source", "text"), drop_text=True)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS w
      FROM d GROUP BY source),
o AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level,
             row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST) AS nth FROM s
      WINDOW b AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, nth) FILTER (WHERE level * w <= 3 * source_size) AS level FROM o),
t AS (SELECT source, source_size, least(w * l.level, 3.0::DOUBLE * source_size) AS target,
             ('0x' || substr(md5('7|' || coalesce(source, chr(0))), 1, 4))::INTEGER / 65536.0::DOUBLE AS z FROM o, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, z, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS nth
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor(z + (nth + 1) * e) - floor(z + nth * e), ceil(e)) AS BIGINT) AS taken
FROM r
"""
