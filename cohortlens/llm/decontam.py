"""Benchmark decontamination: SimHash windows of an item's size, found by multi-index Hamming blocks, verified exactly.

Words are runs of letters and digits, lower-cased.  A document window has as many words as the item; its shingles are five words
(fewer words: all of them).  A window that shares no shingle with any item has similarity 0, so windows are taken where a shared
shingle puts an item's start.  Each gets a 64-bit SimHash of its shingles, weighted by how often they occur.  Fingerprints
within ``RADIUS`` bits of an item of that size are found without loss: 64 bits are cut into ``BLOCKS`` blocks, one
of which differs in at most RADIUS // BLOCKS bits, so items are listed under every block value that near, and a window looks up its own
block values.  The pairs found are verified by the exact weighted-shingle similarity: the sum of the smaller counts of all
shingles over the sum of the larger ones.

Defined results: null or empty texts and items match nothing; equal rows share one verdict; a null doc_id is a
doc_id like others; an empty benchmark or document table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import fresh, narrow, small
from cohortlens.session import cut_lineage

RADIUS, BLOCKS, BITS = 19, 5, 64
#: Distinct item shingles that are looked up inside the scan; more are joined by a shuffle.
MOST_LITERALS = 50_000
#: Documents to drop (two longs each) that may be broadcast.
MOST_DROPPED = 1_000_000


def word_list(text: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.split(F.when(clean != "", clean), " ")


def shingle_hashes(words: str, k: int) -> str:
    """SQL for the hashes of the k-word shingles of an array of at least k words."""
    parts = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return f"transform(sequence(0, size({words}) - {k}), i -> xxhash64({parts}))"


def weighted_shingles(words: str, k: int) -> str:
    """SQL for the hashes of all shingles, repeats included, of an array of 1 or more words."""
    cases = " ".join(f"WHEN size({words}) = {j} THEN {shingle_hashes(words, j)}" for j in range(1, k))
    return f"CASE {cases} ELSE {shingle_hashes(words, k)} END"


def simhash(hashes: str) -> str:
    """SQL for the 64-bit majority fingerprint of an array of hashes."""
    votes = f"aggregate({hashes}, 0, (n, h) -> n + CAST(shiftright(h, b) & 1L AS INT))"
    return f"aggregate(sequence(0, 63), 0L, (f, b) -> f | IF(2 * {votes} > size({hashes}), shiftleft(1L, b), 0L))"


def _blocks() -> list[tuple[int, int]]:
    edges = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def _block_values(near: bool) -> Column:
    """Array of (block, value) of a fingerprint ``fp``; with ``near`` all values within RADIUS // BLOCKS bits."""
    out = []
    for number, (start, width) in enumerate(_blocks()):
        own = f"(shiftrightunsigned(fp, {start}) & {(1 << width) - 1}L)"
        masks = f"filter(sequence(0, {(1 << width) - 1}), m -> bit_count(m) <= {RADIUS // BLOCKS})" if near else "array(0)"
        out.append(f"transform({masks}, m -> struct({number} AS block, {own} ^ CAST(m AS BIGINT) AS value))")
    return F.expr(f"concat({', '.join(out)})")


def item_index(benchmark: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, words, n, hashes, fp) and their shingles (k, hash, start, n): hash is the start-th shingle of an item of n words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_list(F.col("text").cast("string")).alias("words"))
    items = items.where("words is not null").distinct()
    items = items.selectExpr("item_id", "size(words) AS n", f"{weighted_shingles('words', shingle)} AS hashes")
    items = cut_lineage(items.selectExpr("*", f"{simhash('hashes')} AS fp"), "items")
    index = items.select("n", F.least("n", F.lit(shingle)).alias("k"), F.posexplode("hashes").alias("start", "hash"))
    return items, cut_lineage(index.distinct(), "item-shingles")


def windows(docs: DataFrame, index: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, start, n, words): item-sized windows at the places where a shared shingle puts an item's start."""
    most = index.agg(F.max("n")).first()[0]
    if most is None:
        return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(0).alias("start"), F.lit(0).alias("n"),
                           F.array("text").alias("words")).where("false")
    kinds = [r[0] for r in index.select("k").distinct().orderBy("k").collect()]  # at most `shingle` numbers
    cut = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), word_list(F.col("text")).alias("w"))
    around = f"slice(w, greatest(p - {most}, 0) + 1, {2 * most + shingle})"
    found = []
    if index.count() <= MOST_LITERALS:
        for k in kinds:
            known = ", ".join(f"{r[0]}L" if r[0] != -(1 << 63) else f"CAST({r[0]} AS BIGINT)"
                              for r in index.where(F.col("k") == k).select("hash").distinct().collect())
            parts = ", ".join(f"w[i + {j}]" for j in range(k))
            places = f"filter(sequence(0, size(w) - {k}), i -> xxhash64({parts}) IN ({known}))"
            at = cut.select("doc_id", "text_hash", "w", F.explode(F.expr(f"IF(size(w) >= {k}, {places}, array())")).alias("p"))
            parts = ", ".join(f"w[p + {j}]" for j in range(k))
            found.append(at.selectExpr("doc_id", "text_hash", "p", f"{k} AS k", f"xxhash64({parts}) AS hash", f"{around} AS near"))
        hits = reduce(DataFrame.union, found).join(F.broadcast(index), ["k", "hash"])  # at most MOST_LITERALS rows
    else:
        for k in kinds:
            hashes = F.expr(f"IF(size(w) >= {k}, {shingle_hashes('w', k)}, array())")
            hashes = cut.select("doc_id", "text_hash", F.posexplode(hashes).alias("p", "hash"))
            found.append(hashes.withColumn("k", F.lit(k)))
        places = reduce(DataFrame.union, found).join(index, ["k", "hash"])
        keyed = cut.dropDuplicates(["doc_id", "text_hash"]).selectExpr("doc_id AS d", "text_hash AS t", "w")
        hits = places.join(keyed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
        hits = hits.selectExpr("doc_id", "text_hash", "p", "k", "hash", "start", "n", f"{around} AS near")
    # the window starts at p - start; `near` starts at max(p - most, 0)
    span = hits.selectExpr("doc_id", "text_hash", "greatest(p - start, 0) AS b", "p - start + n AS e", "n", "near", f"greatest(p - {most}, 0) AS o")
    span = span.selectExpr("doc_id", "text_hash", "b AS start", "n", "slice(near, b - o + 1, e - b) AS words")
    return span.groupBy("doc_id", "text_hash", "start", "n").agg(F.max("words").alias("words"))


def matches(docs: DataFrame, benchmark: DataFrame, *, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, item_id, start, n, similarity): every window that is at least ``least`` similar to an item of its size."""
    items, index = item_index(benchmark, shingle)
    found = windows(narrow(docs), index, shingle).selectExpr("doc_id", "text_hash", "start", "n", f"{weighted_shingles('words', shingle)} AS own")
    found = cut_lineage(found.selectExpr("*", f"{simhash('own')} AS fp"), "windows")
    listed = items.select("item_id", "n", F.col("fp").alias("item_fp"), F.explode(_block_values(True)).alias("b")).select("item_id", "n", "item_fp", "b.block", "b.value")
    asked = found.select("doc_id", "text_hash", "start", "n", "fp", F.explode(_block_values(False)).alias("b")).select(
        "doc_id", "text_hash", "start", "n", "fp", "b.block", "b.value")
    near = asked.join(listed, ["n", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    near = near.groupBy("doc_id", "text_hash", "start", "n", "item_id").agg(F.first("fp").alias("fp"))
    key = ["text_hash", "start", "n"]
    near = near.select("doc_id", *key, "item_id").join(
        found.select(F.col("doc_id").alias("d"), *(F.col(c).alias(f"{c}_") for c in key), "own"),
        F.col("doc_id").eqNullSafe(F.col("d")) & reduce(Column.__and__, [F.col(c) == F.col(f"{c}_") for c in key]))
    near = near.join(items.select(F.col("item_id").alias("i"), "hashes"), F.col("item_id").eqNullSafe(F.col("i")))
    count = "CAST(size(filter({0}, x -> x = s)) AS BIGINT)"
    totals = lambda f: f"aggregate(array_union(own, hashes), 0L, (t, s) -> t + {f}({count.format('own')}, {count.format('hashes')}))"
    near = near.selectExpr("doc_id", "text_hash", "item_id", "start", "n", f"{totals('least')} / CAST({totals('greatest')} AS DOUBLE) AS similarity")
    return near.where(F.col("similarity") >= least)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without a benchmark passage, with their own columns.

    Texts are shuffled only if the documents to drop are too many to broadcast.
    """
    d, t, text = fresh(docs, "__d", "__t", "__text")
    bad = matches(docs, benchmark, shingle=shingle, least=least).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct()
    keyed = docs.withColumn(text, F.xxhash64(F.col("text").cast("string")))
    return keyed.join(small(bad, MOST_DROPPED, "leaks"), F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col(text) == F.col(t)), "left_anti").drop(text)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item found in it: the best similarity, where it starts (in words) and its number of windows."""
    found = matches(docs, benchmark)
    best = F.max_by(F.struct("start", "n", "similarity"), F.struct("similarity", -F.col("start")))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"), F.count("*").alias("n_windows"))
    return found.select("doc_id", "item_id", F.round("b.similarity", 6).alias("similarity"), F.col("b.start").alias("start_word"),
                        F.col("b.n").alias("n_words"), "n_windows")
