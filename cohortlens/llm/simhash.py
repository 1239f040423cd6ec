"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius through BK-trees.

Links are found in shards.  The 64 bits are cut into ``radius + 3`` blocks; two fingerprints within the radius agree in
at least three whole blocks, so for every choice of three blocks the fingerprints with equal bits there form one shard and
each link lies inside a shard.  Every shard is a BK-tree (children keyed by their integer Hamming distance to the parent),
searched along the edges within the radius only.  Shard trees travel to their tasks by the shuffle on the shard key, as a
driver-side broadcast would collect the fingerprints of all documents; a shard with more than ``MOST`` fingerprints
is dealt out as trees of at most about ``MOST`` nodes, each met by the queries of every tree of the shard.

Equal fingerprints are one node.  A task reports, for each node that has links, one link to the smallest node of its
group in that task, which keeps all groups connected; components follow by alternating large-star and small-star steps.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortlens.llm.common import chunks, fresh, narrow, small, texts_of
from cohortlens.session import cut_lineage

#: Fingerprints in one BK-tree.
MOST = 4096
#: Ids (8 bytes each) that may be broadcast.
MOST_IDS = 2_000_000
#: Rows that a task takes at a time for a forest of shard trees.
FOREST = 200_000


# fingerprints


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64; no word: zero; fewer words: the whole sequence."""
    words = text.lower().split()  # bytes: A-Z only
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > shingle:
        starts, ends = starts[: -shingle + 1 or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())]), np.uint8)
    set_bits = np.zeros(64, np.int64)
    for part in range(0, len(h), 8 << 16):
        set_bits += np.unpackbits(h[part : part + (8 << 16)].reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp long) for each row: the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                fp = np.array([fingerprint(t, shingle, seed) for t in texts_of(part.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return narrow(docs).mapInArrow(run, "doc_id long, fp long")


# BK-trees


class Forest:
    """BK-trees of many shards at once, in arrays; ``shard`` is the number of the shard of each value."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        n = len(values)
        self.values = values
        self.child = np.full((n, 65), -1, np.int32)  # child[node, distance]
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.zeros(0, np.int64)
        self.root = dict(zip(shard[first].tolist(), first.tolist()))
        left = np.setdiff1d(np.arange(n), first)
        node = first[np.searchsorted(shard[first], shard[left])]
        while len(left):  # all trees grow a level at a time
            d = np.bitwise_count(values[left] ^ values[node]).astype(np.int64)
            edge = node * 65 + d
            _, new = np.unique(edge, return_index=True)  # the first one of an edge becomes the child
            self.child[node[new], d[new]] = left[new]
            stays = np.ones(len(left), bool)
            stays[new] = False
            node, left = self.child[node[stays], d[stays]].astype(np.int64), left[stays]

    def search(self, query: np.ndarray, start: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, node) of each value within the radius, in the tree whose root is ``start``."""
        found = []
        who, node = np.arange(len(query)), start
        while len(who):
            d = np.bitwise_count(query[who] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            found.append((who[near], node[near]))
            steps = []
            for k in range(-radius, radius + 1):
                to = d + k
                ok = np.flatnonzero((to >= 0) & (to <= 64))
                nxt = self.child[node[ok], to[ok]]
                hit = nxt >= 0
                steps.append((who[ok[hit]], nxt[hit].astype(np.int64)))
            who, node = (np.concatenate(x) for x in zip(*steps))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's group, under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links_inside(values: np.ndarray, shard: np.ndarray, kind: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of complete shards, ordered by shard: kind 0 is a node and a query, 1 a node only, 2 a query only."""
    grown = kind < 2
    forest = Forest(values[grown], shard[grown])
    asks = np.flatnonzero(kind != 1)
    root = np.array([forest.root.get(s, -1) for s in shard[asks].tolist()], np.int64)
    asks, root = asks[root >= 0], root[root >= 0]
    at = np.flatnonzero(grown)
    a, b = [], []
    for k in range(0, len(asks), 16_384):
        who, node = forest.search(values[asks[k : k + 16_384]], root[k : k + 16_384], radius)
        a.append(asks[k + who])
        b.append(at[node])
    a, b = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
    names, place = np.unique(values, return_inverse=True)
    label = groups(len(names), place[a], place[b])
    far = label != np.arange(len(names))
    return names[far].view(np.int64), names[label[far]].view(np.int64)


def _shards(fps: DataFrame, radius: int) -> DataFrame:
    """(shard, fp): each fingerprint under every choice of three of the radius + 3 blocks."""
    n = radius + 3
    edges = [64 * k // n for k in range(n + 1)]
    keys = []
    for number, kept in enumerate(itertools.combinations(range(n), 3)):
        mask = sum(((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in kept)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask))))
    return fps.select("fp", F.explode(F.array(*keys)).alias("shard"))


def links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints ``fps`` (fp) within the radius."""
    dealt = _shards(fps, radius)
    # A shard of one fingerprint has no link.  A shard over MOST is cut into trees; cell (i, j), i <= j, searches tree i for j's members.
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("shard", F.ceil(F.col("n") / MOST).cast("int").alias("trees"))
    rows = dealt.join(sizes, "shard")
    tree = F.pmod(F.xxhash64("fp", "shard"), F.col("trees")).cast("int")
    other = F.sequence(F.lit(0), F.col("trees") - 1)
    cell = F.transform(other, lambda k: F.struct(F.least(k, tree).alias("i"), F.greatest(k, tree).alias("j"),
                                                 F.when(k == tree, 0).when(k > tree, 1).otherwise(2).alias("kind")))
    rows = rows.select("shard", "fp", F.explode(cell).alias("c")).select(
        F.xxhash64("shard", "c.i", "c.j").alias("shard"), "fp", F.col("c.kind").alias("kind"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def search(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            cols = [np.concatenate(c) for c in zip(*held)]
            end = len(cols[0]) if last else int(np.searchsorted(cols[0], cols[0][-1]))  # the last shard may go on
            held, size = [tuple(c[end:] for c in cols)], len(cols[0]) - end
            if end:
                shard, fp, kind = (c[:end] for c in cols)
                a, b = _links_inside(fp.view(np.uint64), shard, kind, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "fp", "kind")))
            size += batch.num_rows
            if size >= FOREST:
                yield from search(False)
        if held:
            yield from search(True)

    return rows.mapInArrow(run, "a long, b long").distinct()


# components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node of the component of each node of ``edges`` (a, b), by alternating star steps.

    Each round writes its edges to the shared checkpoint folder, so a lost executor repeats one round at most.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        # large: neighbours above a node go to the least of its neighbourhood; small: those below, and the node itself
        near = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("u", "m").alias("m"))
        moved = near.join(least, F.col("a") == F.col("u"))
        moved = moved.where("b > a").select("b", "m") if large else moved.select("b", "m").union(least.select("u", "m"))
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()

    edges = cut_lineage(edges.where("a != b"), name)
    before = None
    while True:
        edges = cut_lineage(star(star(edges, True), False), name)
        # a fixed point of both steps is a set of stars: every node once, under its root
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, fp (long) and component_id, the smallest doc_id that links reach, for each row of ``docs``.

    Null texts are empty, and texts without words have the fingerprint zero, linked like any other.  A null doc_id
    is never the smallest id of a group that has others; a group of null ids only has a null id.  Repeated rows are
    one row each.  An empty table gives an empty table.
    """
    prints = cut_lineage(with_fingerprints(docs, shingle, seed), "simhash")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    root = components(links(nodes.select("fp"), radius), "simhash-links")
    named = nodes.join(root, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut_lineage(named.join(ids, "root").select("fp", "component_id"), "simhash-groups")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs, shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest doc_id (of rows that repeat a doc_id one); same columns.

    A row without a doc_id can't be told from others and stays.  The texts are shuffled only if the ids to leave out
    are too many to broadcast, and those of rows that repeat an id.
    """
    found = near_duplicates(docs, shingle=shingle, radius=radius).where("doc_id IS NOT NULL")
    found = found.withColumn("stays", F.col("component_id") == F.col("doc_id"))
    name, fp = fresh(docs, "__id", "__fp")
    ids = found.groupBy(F.col("doc_id").alias(name)).agg(F.max("stays").alias("stays"), F.count("*").alias("times"))
    ids = cut_lineage(ids.where("NOT stays OR times > 1"), "simhash-ids")
    same_id = F.col("doc_id").cast("long") == F.col(name)
    kept = docs.join(small(ids.select(name), MOST_IDS, "simhash-gone"), same_id, "left_anti")
    again = cut_lineage(ids.where("stays").select(name), "simhash-again")
    if again.isEmpty():
        return kept
    # an id on several rows: the row with the fingerprint that stands for the group
    rows = _fingerprinted(docs.join(small(again, MOST_IDS, "simhash-repeated"), same_id, "left_semi"), fp, shingle)
    stays = found.where("stays").select(F.col("doc_id").alias(name), F.col("fp").alias("f")).distinct()
    rows = rows.join(stays.join(again, name), same_id & (F.col(fp) == F.col("f"))).select([F.col(f"`{c}`") for c in docs.columns])
    return kept.union(rows.dropDuplicates(["doc_id"]))


def _fingerprinted(docs: DataFrame, name: str, shingle: int, seed: int = 42) -> DataFrame:
    """All columns of ``docs`` and the fingerprint."""
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    at, fields = docs.columns.index("text"), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names=fields)

    return docs.mapInArrow(run, schema)
