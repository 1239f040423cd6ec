"""Sharding: contiguous shards of nearly equal bytes, cut from global prefix sums of document sizes.

Documents are put in one global order (doc_id, then checksum and size; null ids first).  Totals for each range partition give the
bytes before every partition; only the partitions that hold a cut are summed row by row.  A document goes to the
shard of its first byte: ``floor(bytes before it * shards / all bytes)``.

Defined results: a null text counts as no text, a size has 8 bytes more than the UTF-8 text, repeated rows are rows
of their own, one very long document may leave shards after it without a row, an empty table gives an empty table,
other columns pass through, but for those that have the name of a result column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import fresh, named, ordered, row_of, task_of
from cohortlens.session import cut_lineage


def shard_documents(docs: DataFrame, shards: int = 24, *, doc_id: str = "doc_id", text: str = "text", drop_text: bool = False,
                    names: tuple[str, str, str, str] = ("size", "text_crc32", "shard", "slot")) -> DataFrame:
    """All columns of ``docs`` (but the text, if ``drop_text``) with size (bytes + 8), text_crc32, shard (int) and slot (long, gapless from 0 in a shard)."""
    size, crc, at, shard, slot = fresh(docs, "__size", "__crc", "__at", "__shard", "__slot")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    sized = docs.withColumns({size: F.octet_length(body).cast("long") + 8, crc: F.crc32(body.cast("binary"))})
    sized = sized.drop(text) if drop_text else sized
    rows = ordered(sized, [F.col(f"`{doc_id}`"), F.col(crc), F.col(size)], at, "shard-rows")
    cut = _cut(rows, shards, size, at, shard, slot).drop(at)
    return named(cut, dict(zip((size, crc, shard, slot), names)))


def _cut(rows: DataFrame, shards: int, size: str, at: str, shard: str, slot: str) -> DataFrame:
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    tasks = rows.groupBy(task_of(at).alias("task")).agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
    tasks = cut_lineage(tasks.select(
        "task", "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")), "shard-tasks")
    total = tasks.agg(F.sum("bytes")).first()[0] or 1
    # the row that follows b bytes is in shard b * shards div total
    whole = tasks.selectExpr("task", "bytes_before", "rows_before", f"(bytes_before * {shards}) div {total} AS low",
                             f"((bytes_before + bytes - 1) * {shards}) div {total} AS high")
    holds_cut = F.broadcast(whole.where("low < high").select("task", "bytes_before"))  # fewer rows than shards
    inside = Window.partitionBy("task").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.select(task_of(at).alias("task"), at, size).join(holds_cut, "task")
    summed = summed.withColumn("b", F.col("bytes_before") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    first = summed.selectExpr(f"(b * {shards}) div {total} AS shard", f"`{at}` AS at").union(
        whole.where("low = high").select(F.col("low").alias("shard"), F.shiftleft("task", 33).alias("at")))
    first = first.groupBy("shard").agg(F.min("at").alias("at"))  # at most a row for each shard
    starts = first.join(tasks, F.shiftright("at", 33) == F.col("task")).select(
        "shard", "at", (F.col("rows_before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))
    starts = sorted((tuple(r) for r in starts.collect()), reverse=True)

    def pick(place: int) -> Column:
        """The shard (0) or its first row's rank (2) of a row, by its position."""
        return reduce(lambda rest, s: F.when(F.col(at) >= s[1], F.lit(s[place])).otherwise(rest), reversed(starts), F.lit(0))

    task, rank = fresh(rows, "__task", "__rank")
    ranks = F.broadcast(tasks.select(F.col("task").alias(task), F.col("rows_before").alias(rank)))  # a row for each partition
    numbered = rows.join(ranks, task_of(at) == F.col(task))
    return numbered.withColumns({
        shard: pick(0).cast("int"), slot: (F.col(rank) + row_of(at) - pick(2)).cast("long")}).drop(task, rank)


def digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    out = shard_documents(docs.select("doc_id", "text"), shards, drop_text=True)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
