"""Hashed-text features and the bounded, labelled sample that the two quality models are fitted on.

Features of a text, hashed into ``BUCKETS`` buckets: every distinct word (lower-cased, punctuation cut off
its ends) and every character trigram (bytes) of the distinct words, with ``log1p`` of the number of distinct words that
have the feature, divided by the root of the number of distinct words.  One more feature is the share of
words that equal the word before.  An empty text has no feature at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import Grown, WordNumbers, chunks, expand, narrow, texts_of

BUCKETS = 1 << 18
_EDGE = b".,;:!?*#$%&|<>()'\""
_MUL = np.uint64(0x9E3779B97F4A7C15)


class HashedText:
    """Turns texts into (row, bucket, value) arrays; remembers the buckets of a bounded number of words."""

    def __init__(self) -> None:
        self.buckets, self.start, self.count = Grown(np.int32, 1 << 20), Grown(np.int64), Grown(np.int64)
        self.words = WordNumbers(self._learn, self._forget)

    def _forget(self) -> None:
        for g in (self.buckets, self.start, self.count):
            g.clear()

    def _learn(self, new: list[bytes]) -> None:
        whole = np.fromiter((zlib.crc32(w.lower().strip(_EDGE)) for w in new), np.int64, len(new)) % BUCKETS
        size = np.fromiter(map(len, new), np.int64, len(new))
        flat = np.frombuffer(b" " + b"  ".join(new) + b" ", np.uint8).astype(np.uint64)  # " word " for each word
        first = np.cumsum(size + 2) - (size + 2)
        at = expand(first, size)  # trigrams of " word ": one for each of its bytes
        h = ((flat[at] * _MUL + flat[at + 1]) * _MUL + flat[at + 2]) * _MUL
        tri = ((h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - 18)).astype(np.int64)
        own = np.repeat(np.arange(len(new)), size)
        total = size + 1
        start = np.cumsum(total) - total
        out = np.empty(int(total.sum()), np.int32)
        out[start] = whole
        out[np.arange(len(tri)) + own + 1] = tri
        self.start.extend(start + self.buckets.n)
        self.count.extend(total)
        self.buckets.extend(out)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, value), ordered by row; the repeat feature has the bucket BUCKETS."""
        cut = [t.split() for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        code = self.words([w for c in cut for w in c])
        row = np.repeat(np.arange(len(cut)), n)
        same = np.bincount(row[1:][(code[1:] == code[:-1]) & (row[1:] == row[:-1])], minlength=len(cut))
        pair = np.unique((row << 32) | code)
        prow, pcode = pair >> 32, pair & 0xFFFFFFFF
        distinct = np.bincount(prow, minlength=len(cut))
        count = self.count.values[pcode]
        bucket = self.buckets.values[expand(self.start.values[pcode], count)]
        key, times = np.unique((np.repeat(prow, count) << 20) | bucket, return_counts=True)
        krow = key >> 20
        value = 3 * np.log1p(times) / np.sqrt(distinct[krow])
        has = np.flatnonzero(same)
        row = np.concatenate([krow, has])
        order = np.argsort(row, kind="stable")
        bucket = np.concatenate([key & 0xFFFFF, np.full(len(has), BUCKETS)])
        value = np.concatenate([value, 3 * same[has] / n[has]])
        return row[order], bucket[order].astype(np.int32), value[order].astype(np.float32)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[np.ndarray, ...]:
    """Features of at most ``max_rows`` labelled texts, as (row, bucket, value, label) arrays.

    ``labels`` is (doc_id, label double).  The ids with the smallest hash are taken, so the sample does not depend on
    the partitioning.  Rows without a label are left out; an id labelled or stored more than once counts once, with
    its smallest label and smallest text.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    texts = narrow(docs).join(F.broadcast(ids), F.col("doc_id") == F.col("id"))  # at most max_rows small rows
    one = texts.groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = HashedText()
        for batch in batches:
            for part in chunks(batch):
                row, bucket, value = hashed(texts_of(part.column("text")))
                edge = np.searchsorted(row, np.arange(part.num_rows + 1))
                cells = [(bucket[a:b].tobytes(), value[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array([c[0] for c in cells], pa.binary()),
                     pa.array([c[1] for c in cells], pa.binary())],
                    names=["id", "label", "bucket", "value"])

    got = one.mapInArrow(features, "id long, label double, bucket binary, value binary").toArrow().sort_by("id")
    buckets = [np.frombuffer(b, np.int32) for b in got.column("bucket").to_pylist()]
    values = [np.frombuffer(b, np.float32) for b in got.column("value").to_pylist()]
    row = np.repeat(np.arange(len(buckets), dtype=np.int32), [len(b) for b in buckets])
    flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    return row, flat(buckets, np.int32), flat(values, np.float32), got.column("label").to_numpy()


def ascend(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int, slope, extra: int, *, least_docs: int = 4,
           l2: float = 1e-4, steps: int = 120, rate: float = 0.5, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Adagrad ascent of a log-likelihood in shared bucket weights and ``extra`` further parameters.

    ``slope(scores, parameters)`` returns the derivatives by score (a row each) and by parameter (means).
    Buckets that fewer than ``least_docs`` rows have keep weight zero.
    """
    weight = np.zeros(BUCKETS + 1)
    known = np.bincount(bucket, minlength=BUCKETS + 1) >= least_docs
    keep = known[bucket]
    row, bucket, value = row[keep], bucket[keep], value[keep].astype(np.float64)
    params = np.zeros(extra) if start is None else start.astype(float)
    seen, seen_p = np.full(BUCKETS + 1, 1e-8), np.full(extra, 1e-8)
    for _ in range(steps):
        score = np.bincount(row, weights=weight[bucket] * value, minlength=n)
        by_score, by_param = slope(score, params)
        g = np.bincount(bucket, weights=by_score[row] * value, minlength=BUCKETS + 1) / max(n, 1) - l2 * weight
        seen += g * g
        seen_p += by_param * by_param
        weight += rate * g / np.sqrt(seen)
        params = params + rate * by_param / np.sqrt(seen_p)
    return weight.astype(np.float32), params


def scores(hashed: HashedText, texts: list[bytes], weight: np.ndarray) -> np.ndarray:
    row, bucket, value = hashed(texts)
    return np.bincount(row, weights=weight[bucket] * value, minlength=len(texts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
