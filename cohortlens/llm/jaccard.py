"""N-gram Jaccard join: documents whose sets of word shingles have a similarity of at least ``PERCENT`` / 100, through count-vector R-trees.

A document's set holds its distinct ``SHINGLE``-word shingles, A-Z lower-cased (fewer words: the whole sequence; none: empty, linked with nothing); a shingle
stands as a 64-bit hash.  Its point counts the shingles of each of ``GROUPS`` groups.  Two sets share at most the sum of
their points' coordinate minima, and a query shares at most the minima with a rectangle's upper corner with any point inside.
So an R-tree search descends only where that sum, with the sizes, still allows the similarity; pairs that survive at the leaves are verified on the whole sets.

One tree over all documents would not do: in so many dimensions its rectangles overlap.  Equal sets are one node, and trees are built

1. over the runs of nodes with equal least hash (ordered by it, size and set, dealt out by range, a bounded number to a tree): what is verified there
   joins most groups of near copies, each set having been shuffled once;
2. over the shards of a prefix key: with all shingles in one order (frequent hash buckets last, then by hash), sets of n and m shingles that are near share at
   least k of their first n - ceil(n * PERCENT / 100) + k and m - ceil(m * PERCENT / 100) + k shingles; k = 1 + n div ``PART`` grows with the smaller set.  Only shards with
   nodes of different groups are looked at, and a pair counts if it survives in k shards.  The first search asks, for each node and each other
   group, for the best pair of a shard only.  Where it left pairs out and the groups are still apart when the best ones are verified, the second asks for all pairs between them
   that were not yet tested.  So every link is inside a group in the end and no pairs are made inside groups.

A shard of more than ``MOST`` nodes is dealt out as trees of about MOST points, each met by the queries of every tree of the shard.

Defined results: null and blank texts have no shingle and are their own component; a null doc_id is never the smallest of a component that has others; repeated
rows are a row each; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import Grown, WordNumbers, chunks, expand, join_hot, narrow, small, texts_of, wide
from cohortlens.llm.simhash import components
from cohortlens.session import cut_lineage, wide_rows

SHINGLE, PERCENT = 4, 85
#: Coordinates of a point.
GROUPS = 128
#: Points in a tree, and in a leaf.
MOST, LEAF = 4096, 16
#: Sets in a tree of the first kind.
MOST_IN_RUN = 2048
#: Queries that search a tree at a time.
ASKED = 128
#: Shingles of the sets that a task holds for one tree of the first kind.
HELD = 2_000_000
#: Bits of the hash buckets whose numbers of shingles are counted, and the buckets a task reports, and that count as frequent at most.
BUCKET_BITS, REPORTED, FREQUENT = 20, 4096, 16_384
#: Bytes of text that a task cuts into words at a time, and distinct words it remembers.
CUT_BYTES, MOST_WORDS = 1 << 18, 1 << 16
#: Rows that a task takes at a time for shards of keys.
FOREST = 16_000
#: Pairs of a task that are passed on at a time.
FOUND = 200_000
#: Shingles of a set for each further key that it has to share.
PART = 64
#: Nodes, keys and points that may be broadcast; shingles of sets to verify that may be broadcast.  Points and sets are far wider than nodes and keys.
MOST_NODES, MOST_KEYS, MOST_POINTS, MOST_SHINGLES = 1_000_000, 1_000_000, 4_000, 250_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def _freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; Arrow's pool gives back what it keeps of those before, as workers stay for other tasks."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


# sets


class Shingles:
    """Sorted distinct shingle hashes of texts; a bounded number of words is remembered with their hashes."""

    def __init__(self, size: int):
        self.size = size
        self.hashes = Grown(np.uint64)
        self.words = WordNumbers(lambda new: self.hashes.extend(np.array([xxhash.xxh3_64_intdigest(w) for w in new], np.uint64)), self.hashes.clear, MOST_WORDS)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        cut = [t.lower().split() for t in texts]
        number = self.words([w for c in cut for w in c])
        word = self.hashes.values[number]
        ends = np.cumsum([len(c) for c in cut])
        return [self._of(word[e - len(c) : e]) for c, e in zip(cut, ends.tolist())]

    def _of(self, word: np.ndarray) -> np.ndarray:
        if not len(word):
            return np.zeros(0, np.uint64)
        k = min(self.size, len(word))
        h = np.full(len(word) - k + 1, k, np.uint64)  # shorter sequences equal no longer one
        for i in range(k):
            h = (h ^ h >> np.uint64(29)) * _MIX[i % 4] + word[i : len(word) - k + 1 + i]
        for c in _MIX[4:]:
            h = (h ^ h >> np.uint64(33)) * c
        return np.unique(h ^ h >> np.uint64(33))


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, least, h1, h2, shingles) of each row: size, smallest hash, a 128-bit identity and the sorted hashes of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in _freed(batches):
            for part in chunks(batch, size=CUT_BYTES):
                found = shingles(texts_of(part.column("text")))
                n = np.array([len(s) for s in found], np.int64)
                raw = [s.tobytes() for s in found]
                name = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, raw)), np.int64).reshape(-1, 2)
                least = np.array([s[0] if len(s) else 0 for s in found], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(least), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy()), pa.array(raw, pa.binary())],
                    names=["doc_id", "n", "least", "h1", "h2", "shingles"])

    return narrow(docs).mapInArrow(run, "doc_id long, n long, least long, h1 long, h2 long, shingles binary")


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sets of a column without nulls, as views: a batch of sets isn't copied."""
    if not len(column):
        return []
    place = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    edge = np.frombuffer(column.buffers()[1], place)[column.offset : column.offset + len(column) + 1].tolist()
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[a:b].view(np.uint64) for a, b in zip(edge, edge[1:])]


def _point(s: np.ndarray) -> np.ndarray:
    """Counts by the low bits of the hash, which neither order nor buckets use."""
    return np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(np.uint32)


def _packed(point: np.ndarray) -> bytes:
    """A point's coordinates in four bits each if all are below 16, else in a byte or in four; a point is shuffled with every key of its node."""
    top = point.max()
    if top < 16:
        return (point[0::2] | point[1::2] << 4).astype(np.uint8).tobytes()
    return point.astype(np.uint8 if top < 256 else np.uint32).tobytes()


def _unpacked(raw: list[bytes]) -> np.ndarray:
    """The points that ``_packed`` wrote, as rows."""
    out = np.empty((len(raw), GROUPS), np.uint32)
    width = np.fromiter(map(len, raw), np.int64, len(raw))
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        data = np.frombuffer(b"".join(raw[i] for i in at.tolist()), np.uint32 if w > GROUPS else np.uint8).reshape(len(at), -1)
        if w < GROUPS:
            out[at, 0::2], out[at, 1::2] = data & 15, data >> 4
        else:
            out[at] = data
    return out


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b)
    common = both - len(np.union1d(a, b))
    return 100 * common >= percent * (both - common)


# trees


class Tree:
    """R-tree of points in arrays, bulk-loaded: split at the middle of the widest coordinate (or size) until leaves hold ``LEAF`` points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = np.arange(len(points))
        upper, least, most, first, last, child = [], [], [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            rows = self.order[a:b]
            node = len(first)
            held, n = points[rows], sizes[rows]
            upper.append(held.max(axis=0))
            least.append(n.min())
            most.append(n.max())
            first.append(a)
            last.append(b)
            child.append([])
            if parent >= 0:
                child[parent].append(node)
            if b - a > LEAF:
                spread = np.append(upper[-1] - held.min(axis=0), n.max() - n.min())
                at = int(spread.argmax())
                by = n if at == GROUPS else held[:, at]
                middle = (b - a) // 2
                self.order[a:b] = rows[np.argpartition(by, middle)]
                todo += [(a, a + middle, node), (a + middle, b, node)]
        self.upper, self.least, self.most = np.array(upper), np.array(least), np.array(most)
        self.first, self.last = np.array(first), np.array(last)
        self.child = np.array([c or [-1, -1] for c in child])

    def search(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, most that they share) of all pairs that the points and sizes allow."""
        who, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        leaf_who, leaf = [], []
        while len(who):
            n = sizes[who]
            ok = (100 * self.most[node] >= percent * n) & (100 * n >= percent * self.least[node])
            who, node, n = who[ok], node[ok], n[ok]
            ok = (100 + percent) * shared(points, who, self.upper, node) >= percent * (n + self.least[node])
            who, node = who[ok], node[ok]
            end = self.child[node, 0] < 0
            leaf_who.append(who[end])
            leaf.append(node[end])
            who, node = np.repeat(who[~end], 2), self.child[node[~end]].reshape(-1)
        who, leaf = np.concatenate(leaf_who), np.concatenate(leaf)
        count = self.last[leaf] - self.first[leaf]
        out = []
        for a in range(0, len(leaf), 1 << 14):
            c = count[a : a + (1 << 14)]
            begin = np.repeat(self.first[leaf[a : a + (1 << 14)]] - (np.cumsum(c) - c), c)
            point = self.order[begin + np.arange(int(c.sum()))]
            query = np.repeat(who[a : a + (1 << 14)], c)
            n, m = sizes[query], self.sizes[point]
            ok = (100 * m >= percent * n) & (100 * n >= percent * m)
            query, point = query[ok], point[ok]
            common = shared(points, query, self.points, point)
            ok = (100 + percent) * common >= percent * (sizes[query] + self.sizes[point])
            out.append((query[ok], point[ok], common[ok]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def shared(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of points a[i] and b[j]."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), 1 << 13):
        out[k : k + (1 << 13)] = np.minimum(a[i[k : k + (1 << 13)]], b[j[k : k + (1 << 13)]]).sum(axis=1)
    return out


def _joined(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest member of each set's group, under verified links; pairs that are in one group already are not verified."""
    points, sizes = np.stack([_point(s) for s in sets]), np.array([len(s) for s in sets], np.int64)
    tree = Tree(points, sizes)
    label = np.arange(len(sets))

    def root(x: int) -> int:
        while label[x] != x:
            x = int(label[x])
        return x

    for a in range(0, len(sets), ASKED):
        part = np.arange(a, min(a + ASKED, len(sets)))
        query, point, common = tree.search(points[part], sizes[part], percent)
        query += a
        order = np.lexsort((-common, query))
        query, point = query[order], point[order]
        left = point < query  # each pair from one side
        while True:
            query, point = query[left], point[left]
            left = label[query] != label[point]
            query, point = query[left], point[left]
            if not len(query):
                break
            best = np.r_[True, query[1:] != query[:-1]]  # of each query the best pair that is left
            for i, j in zip(query[best].tolist(), point[best].tolist()):
                x, y = root(i), root(j)
                if x != y and _linked(sets[i], sets[j], percent):
                    label[max(x, y)] = min(x, y)
            while not np.array_equal(label, label[label]):
                label = label[label]
            left = ~best
    return label


# first: runs of one least hash


def near_in_runs(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links that join nodes (node, n, least, h1, shingles) of one least hash, a bounded number at a time; at most one a node."""
    order = ["least", "n", "h1"]
    dealt = nodes.select("node", *order, "shingles").repartitionByRange(wide(nodes), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        now, size = None, 0

        def linked() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                node = np.array([h[0] for h in held], np.int64)
                root = _joined([h[1] for h in held], percent)
                far = root != np.arange(len(root))
                yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[root[far]])], names=["a", "b"])

        for batch in _freed(batches):
            for node, least, s in zip(batch.column("node").to_pylist(), batch.column("least").to_pylist(), _sets(batch.column("shingles"))):
                if least != now or size > HELD or len(held) >= MOST_IN_RUN:
                    yield from linked()
                    held, now, size = [], least, 0
                held.append((node, s.copy()))  # a view would keep the batch
                size += len(s)
        yield from linked()

    return dealt.mapInArrow(run, "a long, b long")


# second: shards of a prefix key


def frequent_buckets(nodes: DataFrame) -> np.ndarray:
    """Numbers of the hash buckets with many more shingles than others, FREQUENT at most: they only order the shingles, so any choice gives the same links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in _freed(batches):
            sets = _sets(batch.column("shingles"))
            for a in range(0, len(sets), 64):
                found = np.concatenate(sets[a : a + 64])
                np.add.at(total, (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        most = np.argpartition(total, -REPORTED)[-REPORTED:]
        most = most[total[most] > 4 * total.mean()]
        yield pa.RecordBatch.from_arrays([pa.array(most), pa.array(total[most])], names=["bucket", "n"])

    found = nodes.select("shingles").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = found.orderBy(F.desc("n"), "bucket").limit(FREQUENT).toArrow()
    return np.sort(found.column("bucket").to_numpy())


def prefix_keys(nodes: DataFrame, percent: int, frequent: np.ndarray) -> DataFrame:
    """(node, group, key): the first shingles of each node's set in the common order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(1 << BUCKET_BITS, bool)
        last[frequent] = True
        for batch in _freed(batches):
            keys, count = [], []
            for s in _sets(batch.column("shingles")):
                p = min(len(s), len(s) - -(-len(s) * percent // 100) + 1 + len(s) // PART)
                late = last[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                early = s[~late][:p]
                keys.append(np.concatenate([early, s[late][: p - len(early)]]))  # not a view of the whole set
                count.append(p)
            key = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
            node, group = (np.repeat(batch.column(c).to_numpy(), count) for c in ("node", "group"))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(group), pa.array(key)], names=["node", "group", "key"])

    return nodes.select("node", "group", "shingles").mapInArrow(run, "node long, group long, key long")


def candidates(grouped: DataFrame, nodes: DataFrame, percent: int, frequent: np.ndarray, best: bool) -> DataFrame:
    """(a, b, more), a < b: pairs of different groups that share enough prefix keys and that points and sizes allow.

    ``grouped`` (node, shingles, group) are looked at; their sizes and sets are read from ``nodes``, which needs no groups.

    ``best``: for each node and other group the best of a shard; ``more`` says that others were left out.
    """
    keys = prefix_keys(grouped, percent, frequent)
    shards = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high")).where("low < high")
    shards = shards.select("key", F.ceil(F.col("n") / MOST).cast("int").alias("trees"))
    shards = small(shards, MOST_KEYS, "jaccard-shards")
    rows = cut_lineage(prefix_keys(grouped, percent, frequent).join(shards, "key"), "jaccard-keys")
    met = small(rows.select("node").distinct(), MOST_NODES, "jaccard-met")
    points = cut_lineage(_with_points(nodes.join(met, "node", "left_semi").select("node", "n", "shingles")), "jaccard-points")
    few = points.count() <= MOST_POINTS
    if not few:  # else they needn't be shuffled with every key
        rows = rows.join(points, "node")
    tree = F.pmod(F.xxhash64("node", "key"), F.col("trees")).cast("int")
    cell = F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda k: F.struct(
        F.least(k, tree).alias("i"), F.greatest(k, tree).alias("j"), F.when(k == tree, 0).when(k > tree, 1).otherwise(2).alias("kind")))
    rows = rows.withColumn("c", F.explode(cell)).withColumns({"shard": F.xxhash64("key", "c.i", "c.j"), "kind": F.col("c.kind")}).drop("key", "c", "trees")
    rows = rows.repartition("shard")
    if few:
        rows = rows.join(F.broadcast(points), "node")
    rows = rows.sortWithinPartitions("shard", "node")  # last: the optimizer drops a sort below a join

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _whole_shards(batches):
            yield from _pairs(*shards, percent, best)

    rows = rows.select("shard", "node", "group", "n", "kind", "point")
    pairs = rows.mapInArrow(run, "a long, b long, need long, more boolean").groupBy("a", "b").agg(
        F.count("*").alias("keys"), F.first("need").alias("need"), F.max("more").alias("more"))
    return pairs.where("more OR keys >= need").select("a", "b", "more")


def _with_points(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _freed(batches):
            points = [_packed(_point(s)) for s in _sets(batch.column("shingles"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(points, pa.binary())], names=["node", "n", "point"])

    return nodes.select("node", "n", "shingles").mapInArrow(run, "node long, n long, point binary")


def _whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(shard, node, group, n, kind, points) of whole shards, from rows ordered by shard."""
    names = ("shard", "node", "group", "n", "kind")
    held: list[np.ndarray] = [np.zeros(0, np.int64) for _ in names] + [np.zeros((0, GROUPS), np.uint32)]
    for batch in _freed(batches):
        points = _unpacked(batch.column("point").to_pylist())
        new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names] + [points]
        held = [np.concatenate(x) for x in zip(held, new)]
        if len(held[0]) >= FOREST:
            end = int(np.flatnonzero(held[0] != held[0][-1])[-1]) + 1 if held[0][0] != held[0][-1] else 0  # the last shard may go on
            if end:
                yield tuple(h[:end] for h in held)
                held = [h[end:] for h in held]
    if len(held[0]):
        yield tuple(held)


def _pairs(shard: np.ndarray, node: np.ndarray, group: np.ndarray, n: np.ndarray, kind: np.ndarray, points: np.ndarray, percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """Candidates of whole shards: kind 0 is a point and a query, 1 a point only, 2 a query only."""
    edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])

    def chosen(a: np.ndarray, b: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, more) of the pairs that count; all pairs of a query, which is a row of one shard, are here."""
        ok = _wanted(a, b, node, group, kind)
        a, b, common = a[ok], b[ok], common[ok]
        if not best or not len(a):
            return a, b, np.zeros(len(a), bool)
        order = np.lexsort((node[b], -common, group[b], a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (group[b[1:]] != group[b[:-1]])])
        return a[new], b[new], np.diff(np.r_[new, len(a)]) > 1

    found = [chosen(*_in_leaves(edge[:-1], np.diff(edge), n, points, percent))]
    for a, b in zip(edge[:-1][np.diff(edge) > LEAF].tolist(), edge[1:][np.diff(edge) > LEAF].tolist()):
        grown, asks = a + np.flatnonzero(kind[a:b] < 2), a + np.flatnonzero(kind[a:b] != 1)
        if len(grown) and len(asks):
            tree = Tree(points[grown], n[grown])
            for k in range(0, len(asks), ASKED):
                ask = asks[k : k + ASKED]
                query, point, common = tree.search(points[ask], n[ask], percent)
                found.append(chosen(ask[query], grown[point], common))
                if sum(len(x[0]) for x in found) > FOUND:
                    yield from _rows_of(found, node, n)
                    found = []
    yield from _rows_of(found, node, n)


def _rows_of(found: list[tuple[np.ndarray, ...]], node: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    if sum(len(x[0]) for x in found):
        a, b, more = (np.concatenate(x) for x in zip(*found))
        need = 1 + np.minimum(n[a], n[b]) // PART
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b])), pa.array(need), pa.array(more)],
                                         names=["a", "b", "need", "more"])


def _wanted(a: np.ndarray, b: np.ndarray, node: np.ndarray, group: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a query and a point are of different groups, each pair once."""
    return (group[a] != group[b]) & ((kind[a] == 2) & (kind[b] == 1) | (kind[a] == 0) & (kind[b] == 0) & (node[a] < node[b]))


def _in_leaves(start: np.ndarray, size: np.ndarray, n: np.ndarray, points: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, most that they share) within the shards that are a single leaf, all at a time."""
    start, size = start[size <= LEAF], size[size <= LEAF]
    row = expand(start, size)
    others = np.repeat(size, size)
    a, b = np.repeat(row, others), expand(np.repeat(start, size), others)
    ok = (a != b) & (100 * n[a] >= percent * n[b]) & (100 * n[b] >= percent * n[a])
    a, b = a[ok], b[ok]
    common = shared(points, a, points, b)
    ok = (100 + percent) * common >= percent * (n[a] + n[b])
    return a[ok], b[ok], common[ok]


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are near."""
    met = small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), MOST_NODES, "jaccard-sides")
    texts = cut_lineage(nodes.join(met, "node", "left_semi").select("node", "n", "shingles"), "jaccard-sets")
    held = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    side = lambda x: texts.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))
    left, right = (F.broadcast(side(x)) if held <= MOST_SHINGLES else side(x) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _freed(batches):
            ok = [_linked(x, y, percent) for x, y in zip(_sets(batch.column("sa")), _sets(batch.column("sb")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


# the whole


def jaccard_components(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) for each row of ``docs``."""
    with wide_rows(docs.sparkSession):  # a set has some kilobytes
        return _components_of(docs, shingle, percent)


def _components_of(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    sets = cut_lineage(sets_of(docs, shingle).withColumn("row", F.monotonically_increasing_id()), "jaccard-all")
    same = sets.where("n > 0").groupBy("h1", "h2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first"), F.min("least").alias("least"), F.count("*").alias("copies"))
    same = cut_lineage(same, "jaccard-same")
    copied = sets.where("n > 0").select("row", "h1", "h2")
    # rows that only repeat a set of another row, by the row that stands for it
    gone = join_hot(copied, same.where("copies > 1").select("h1", "h2", "node", "copies"), ["h1", "h2"]).where("row != node").select(F.col("row").alias("node"))
    nodes = sets.where("n > 0").withColumnRenamed("row", "node").join(small(gone, MOST_NODES, "jaccard-gone"), "node", "left_anti")
    nodes = nodes.select("node", "n", "least", "h1", "shingles")

    runs = small(same.groupBy("least").agg(F.count("*").alias("c")).where("c > 1").select("least"), MOST_NODES, "jaccard-least")
    found = cut_lineage(near_in_runs(nodes.join(runs, "least", "left_semi"), percent), "jaccard-links")
    frequent = frequent_buckets(nodes)
    root = cut_lineage(components(found, "jaccard-groups"), "jaccard-roots")
    pairs = cut_lineage(candidates(_with_groups(nodes, root), nodes, percent, frequent, True), "jaccard-pairs")
    found = cut_lineage(found.union(verified(pairs, nodes, percent)), "jaccard-links")
    if not pairs.where("more").isEmpty():
        root = cut_lineage(components(found, "jaccard-groups"), "jaccard-roots")
        apart = pairs.where("more").join(root.toDF("a", "ra"), "a", "left").join(root.toDF("b", "rb"), "b", "left")
        apart = apart.select(F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")).where("ra != rb")
        left = small(apart.select(F.explode(F.array("ra", "rb")).alias("group")).distinct(), MOST_NODES, "jaccard-apart")
        again = candidates(_of_groups(nodes, root, left), nodes, percent, frequent, False)
        again = cut_lineage(again.join(pairs, ["a", "b"], "left_anti").select("a", "b"), "jaccard-pairs")
        found = cut_lineage(found.union(verified(again, nodes, percent)), "jaccard-links")

    root = components(found, "jaccard-groups")
    named = same.join(root.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    named = cut_lineage(named.select("h1", "h2", "copies", "first", F.coalesce("root", "node").alias("root")), "jaccard-named")
    ids = named.groupBy("root").agg(F.min("first").alias("component"), F.sum("copies").alias("members")).where("members > 1")
    named = cut_lineage(named.join(ids.select("root", "component"), "root").select("h1", "h2", "copies", "component"), "jaccard-components")
    rows = sets.select("doc_id", "n", "h1", "h2")
    out = join_hot(rows, named, ["h1", "h2"], "left")
    lone = (F.col("n") == 0) | F.col("copies").isNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(lone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def _with_groups(nodes: DataFrame, root: DataFrame) -> DataFrame:
    """The nodes (node, shingles) with their groups."""
    held = small(root, MOST_NODES, "jaccard-root").withColumnRenamed("node", "member")
    grouped = nodes.join(held, F.col("node") == F.col("member"), "left")
    return grouped.select("node", "shingles", F.coalesce("root", "node").alias("group"))


def _of_groups(nodes: DataFrame, root: DataFrame, groups: DataFrame) -> DataFrame:
    """The nodes (node, shingles, group) of these groups alone: a root, which ``root`` doesn't list, and what it lists under it."""
    member = root.select(F.col("node").alias("member"), F.col("root").alias("group")).join(groups, "group", "left_semi").select("member", "group")
    member = small(member.union(groups.select(F.col("group").alias("member"), "group")), MOST_NODES, "jaccard-members")
    return nodes.join(member, F.col("node") == F.col("member")).select("node", "shingles", "group")


def digest(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
