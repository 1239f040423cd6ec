"""Periodic runs: maximal stretches of words that repeat with some period, found in O(n log n) of each text.

A run is a stretch [s, e) of at least max(``LEAST``, 2 q) words, q its smallest period, that no neighbouring word extends.  Texts are handled a
slice of a batch at a time, their words numbered and joined with a different number after each text, so that nothing matches across texts.

Longest common extensions come from a difference cover: for places i and j there is an offset below ``COVER`` at which both meet sampled
places.  Only the sampled suffixes are sorted (their first COVER words, then doubling by ranks of COVER, 2 COVER, ... words, as a sampled place
plus COVER is sampled again).  The words up to the offset are compared one by one, the rest is the least of the common
prefixes between the two suffixes' ranks, from a sparse table.  The reversed words give the extensions to the left.

Runs come from the harmonic grid: a run of period q holds a place i = 0, q, 2 q, ... with word i = word i + q, and the extensions of (i, i + q) to both
sides span it.  Multiples of a run's period give the same stretch, so the least period of a stretch is its smallest.

Defined results: a null text has no words and no runs; both checksums are then those of the empty string.  Repeated rows are a row each; an empty table gives
an empty table; other columns aren't read.  A null doc_id has no decimal digits: its text is taken as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.common import WordNumbers, chunks, expand, narrow, texts_of

#: Least words of a run.
LEAST = 12
#: A perfect difference cover: every offset below COVER is a difference of two of its places.
COVER, PLACES = 13, (0, 1, 3, 9)
#: Points of the grid that are looked at a time.
GRID = 1 << 20
RUN = np.dtype([("doc", np.int64), ("start", np.int64), ("length", np.int64), ("period", np.int64)])


def _refined(rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks by ``rank``, then ``key``: a rank is the number of smaller rows, so only rows that share one are sorted again."""
    size = np.bincount(rank, minlength=len(rank))
    tied = np.flatnonzero(size[rank] > 1)
    order = tied[np.lexsort((key[tied], rank[tied]))]
    r, k = rank[order], key[order]
    group, new = np.ones(len(order), bool), np.ones(len(order), bool)
    group[1:] = r[1:] != r[:-1]
    new[1:] = group[1:] | (k[1:] != k[:-1])
    at = np.arange(len(order))
    out = rank.copy()
    out[order] = r + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
    return out


def _offsets() -> np.ndarray:
    """By the two places modulo COVER: the least offset that brings both to sampled places."""
    held = np.isin(np.arange(2 * COVER) % COVER, PLACES)
    out = np.zeros((COVER, COVER), np.int64)
    for a in range(COVER):
        for b in range(COVER):
            out[a, b] = next(d for d in range(COVER) if held[a + d] and held[b + d])
    return out


OFFSETS = _offsets()


class Extensions:
    """Longest common extensions to the right within ``word`` (numbers from 0); the last word has to be there once."""

    def __init__(self, word: np.ndarray):
        n = len(word)
        self.word = np.concatenate([word + 1, np.zeros(2 * COVER, np.int64)])
        place = np.arange(n)[np.isin(np.arange(n) % COVER, PLACES)]
        self.rank_at = np.full(n + 2 * COVER, -1, np.int64)
        m = len(place)
        self.table = [np.zeros(m, np.int32)]
        if not m:
            return
        # first COVER words, as many to a 64-bit number as fit
        bits = int(self.word.max()).bit_length()
        per = max(1, 62 // bits)
        rank = np.zeros(m, np.int64)
        for a in range(0, COVER, per):
            key = np.zeros(m, np.int64)
            for k in range(a, min(a + per, COVER)):
                key = key << bits | self.word[place + k]
            rank = _refined(rank, key)
        number = np.full(n + 2 * COVER, m, np.int64)  # of a sampled place; m: none
        number[place] = np.arange(m)
        levels, span = [], COVER
        while True:
            levels.append((span, rank))
            order = np.full(m, -1, np.int64)
            order[rank] = np.arange(m)
            if order.min() >= 0:  # no rank is shared
                break
            far = number[np.minimum(place + span, n + COVER)]
            rank = _refined(rank, np.append(rank, -1)[far])
            span *= 2
        self.rank_at[place] = rank
        # common prefixes of neighbours: down the levels, then word by word
        at = np.stack([place[order[:-1]], place[order[1:]]])
        length = np.zeros(m - 1, np.int64)
        for span, r in reversed(levels):
            r = np.append(r, -1)
            a, b = (number[np.minimum(x + length, n + COVER)] for x in at)
            length += np.where((r[a] == r[b]) & (a < m) & (b < m), span, 0)
        length = self._by_word(at[0], at[1], length, np.full(m - 1, COVER))
        table = [np.append(0, length).astype(np.int32)]  # position r: with the suffix of rank r - 1
        while 2 << len(table) - 1 <= m:
            half, t = 1 << len(table) - 1, table[-1]
            table.append(np.minimum(t[:-half], t[half:]))
        self.table = table

    def _by_word(self, i: np.ndarray, j: np.ndarray, length: np.ndarray, most: np.ndarray) -> np.ndarray:
        """``length`` and as many of the next ``most`` words as agree."""
        length = length.copy()
        live = np.flatnonzero(most > 0)
        for k in range(1, int(most.max()) + 1 if len(most) else 0):
            live = live[self.word[i[live] + length[live]] == self.word[j[live] + length[live]]]
            length[live] += 1
            live = live[most[live] > k]
            if not len(live):
                break
        return length

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from places i and j on, i != j."""
        offset = OFFSETS[i % COVER, j % COVER]
        length = self._by_word(i, j, np.zeros(len(i), np.int64), offset)
        on = np.flatnonzero(length == offset)
        a, b = self.rank_at[i[on] + offset[on]], self.rank_at[j[on] + offset[on]]
        inside = (a >= 0) & (b >= 0)  # else one of them has come to the end
        on, low, high = on[inside], np.minimum(a, b)[inside] + 1, np.maximum(a, b)[inside]
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = level == k
            t = self.table[k]
            length[on[at]] += np.minimum(t[low[at]], t[high[at] + 1 - (1 << k)])
        return length


def find(word: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs (RUN) of texts with so many words each, by text, start and period; ``word`` has their word numbers one after the other."""
    joined, first = _joined(word, sizes)
    has = np.zeros(len(sizes), bool)
    for doc, q in _grid(sizes, least):
        has[_points(joined, first, sizes, doc, q, least)[0]] = True
    if not has.any():
        return np.zeros(0, RUN)
    # the texts that may have runs
    number, sizes = np.flatnonzero(has), sizes[has]
    joined, first = _joined(joined[expand(first[has], sizes)], sizes)
    last = len(joined) - 1
    right, left = Extensions(joined), Extensions(np.append(joined[::-1][1:], joined.max() + 1))
    found = []
    for doc, q in _grid(sizes, least):
        doc, i, period = _points(joined, first, sizes, doc, q, least)
        ahead, back = right(i, i + period), left(last - i, last - i - period)  # to the left: places of i - 1 and i + period - 1 in the reversed order
        length = ahead + back + period
        ok = length >= np.maximum(least, 2 * period)
        found.append(np.stack([doc[ok], (i - back - first[doc])[ok], length[ok], period[ok]]))
    doc, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = (x[order] for x in (doc, start, length, period))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    out = np.zeros(int(new.sum()), RUN)
    for name, x in zip(RUN.names, (number[doc], start, length, period)):
        out[name] = x[new]
    return out[np.lexsort((out["period"], out["start"], out["doc"]))]


def _joined(word: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, each followed by a number of its own, and where each text starts."""
    out = np.empty(len(word) + len(sizes), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    held = np.ones(len(out), bool)
    held[ends] = False
    out[held], out[ends] = word, (int(word.max()) + 1 if len(word) else 0) + np.arange(len(sizes))
    return out, ends - sizes


def _points(joined: np.ndarray, first: np.ndarray, sizes: np.ndarray, doc: np.ndarray, q: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, period) of the grid: the word one period on is the same, as in so many neighbours as any run has at least."""
    count = (sizes[doc] - 1) // q  # places k * q with k * q + q inside the text
    period = np.repeat(q, count)
    i = np.repeat(first[doc], count) + expand(np.zeros(len(doc), np.int64), count) * period
    same = np.flatnonzero(joined[i] == joined[i + period])
    i, period, doc = i[same], period[same], np.repeat(doc, count)[same]
    need = (least + 1) // 2  # a run's words less one period
    alike = np.ones(len(i), np.int64)
    for step in (1, -1):
        live = np.flatnonzero(alike < need)
        for k in range(1, need):
            at = i[live] + step * k
            live, at = live[at >= 0], at[at >= 0]
            live = live[joined[at] == joined[at + period[live]]]
            if not len(live):
                break
            alike[live] += 1
    ok = alike >= need
    return doc[ok], i[ok], period[ok]


def _grid(sizes: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, period) for all periods up to half of each text, in parts of about GRID points."""
    docs = np.flatnonzero(sizes >= least)
    most = sizes[docs] // 2
    for a in range(0, int(most.sum()), GRID):  # periods of many short texts are many, those of a long one have many points
        edge = np.cumsum(most)
        lo, hi = np.searchsorted(edge, a, "right"), np.searchsorted(edge, min(a + GRID, int(edge[-1])) - 1, "right")
        which = np.arange(lo, hi + 1)
        begin = np.maximum(a - (edge[which] - most[which]), 0)
        stop = np.minimum(a + GRID - (edge[which] - most[which]), most[which])
        doc, q = np.repeat(docs[which], stop - begin), expand(begin, stop - begin) + 1
        points = np.cumsum((sizes[doc] - 1) // q)
        cuts = np.unique(np.searchsorted(points, np.arange(GRID, int(points[-1]) + GRID, GRID), "right"))
        for b, c in zip(np.r_[0, cuts], np.r_[cuts, len(doc)]):
            if c > b:
                yield doc[b:c], q[b:c]


def with_periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text; of one in ten ids a tail is made periodic."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def detect(docs: DataFrame, *, least: int = LEAST, periodic_tails: bool = False) -> DataFrame:
    """doc_id, n_words, the runs (start, length, period) by start and period, and the text's words without the repetitions, joined by a space.

    ``collapsed`` leaves out every word that some run holds after its first period.  ``periodic_tails`` applies ``with_periodic_tail`` first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = WordNumbers(lambda new: None, lambda: None)
        for batch in batches:
            for part in chunks(batch):
                yield from _detected(part, number, least, periodic_tails)

    kind = "struct<start: long, length: long, period: long>"
    return narrow(docs).mapInArrow(run, f"doc_id long, n_words long, runs array<{kind}>, collapsed binary")


def _detected(part: pa.RecordBatch, number: WordNumbers, least: int, periodic_tails: bool) -> Iterator[pa.RecordBatch]:
    ids, words = part.column("doc_id").to_pylist(), [t.split() for t in texts_of(part.column("text"))]
    if periodic_tails:
        words = list(map(with_periodic_tail, ids, words))
    sizes = np.array([len(w) for w in words], np.int64)
    flat = number([x for w in words for x in w])
    runs = find(flat, sizes, least)
    # words that a run holds after its first period
    begin = (np.cumsum(sizes) - sizes)[runs["doc"]] + runs["start"]
    depth = np.zeros(len(flat) + 1, np.int64)
    np.add.at(depth, begin + runs["period"], 1)
    np.add.at(depth, begin + runs["length"], -1)
    gone = np.cumsum(depth) > 0
    edge, at = np.searchsorted(runs["doc"], np.arange(len(words) + 1)), np.cumsum(np.r_[0, sizes])
    collapsed = []
    for k, w in enumerate(words):
        out = gone[at[k] : at[k + 1]]
        collapsed.append(b" ".join(w if edge[k] == edge[k + 1] else [x for x, g in zip(w, out.tolist()) if not g]))
    fields = [pa.array(runs[c]) for c in ("start", "length", "period")]
    listed = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), listed, pa.array(collapsed, pa.binary())],
                                     names=["doc_id", "n_words", "runs", "collapsed"])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and checksums of all runs and of the collapsed text."""
    longest = "array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period))) AS longest"
    return detect(docs, periodic_tails=True).selectExpr("doc_id", "runs", "collapsed", longest).selectExpr(
        "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", "-longest.start AS start", "longest.length AS length", "-longest.period AS period",
        "1000 * longest.length div -longest.period AS exponent_milli",
        "sha2(concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256")
