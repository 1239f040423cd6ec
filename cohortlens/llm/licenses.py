"""License scans: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment reports coverage and spans.

Words are lower-cased and cut free of punctuation at both ends; words of punctuation only are skipped.  The hashes of all ``GRAM``-word
runs are winnowed: of every ``WINDOW`` neighbours the smallest (of equal ones the last) is a fingerprint, so a run of
GRAM + WINDOW - 1 words that a text shares with a template shares a fingerprint.  Of a template under ``SHORT`` words every pair of
neighbouring words is one: four fifths of its words hold such a pair, four fifths of a longer one such a run, wherever words are replaced or left out.  Every diagonal of template and text on which fingerprints
meet is a candidate if the text around it holds words enough of the template; the whole template is aligned against the text there, inside the band.  The coverage is the
share of the template's words that the alignment matches; spans are in words of the text (white-space words, end exclusive).

Defined results: null, empty and short texts match nothing; a template that stands in a text twice is reported twice;
of overlapping reports, of whatever templates, the best stays: the one with the most words matched, less its words missed; repeated rows are reported alike; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import license_texts
from cohortlens.llm.common import Grown, WordNumbers, chunks, narrow, texts_of

GRAM, WINDOW, BAND, LEAST = 3, 2, 8, 0.8
#: Templates of fewer words are found by any two neighbouring words.
SHORT = 16
#: Diagonals on each side that even a short template has.
LEAST_BAND = 4
_EDGE = b".,;:!?()[]{}<>\"'*#/-"
_MUL = np.uint64(0x9E3779B97F4A7C15)

#: The stated list, grant sentences, whole notices and whole licenses, by SPDX-like name.
TEMPLATES = license_texts.load()
#: Words of all templates together that a scan takes: the index travels with the tasks and each worker holds it.
MOST_TEMPLATE_WORDS = 500_000


def word_hash(word: bytes) -> int:
    """Hash of a normalised word; 0 for punctuation only."""
    w = word.lower().strip(_EDGE)
    return (zlib.crc32(w) << 8 | len(w) & 0xFF) + 1 if w else 0


def winnow(words: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the fingerprints of a sequence of word hashes."""
    if len(words) < gram:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        h = (h + words[k : len(words) - gram + 1 + k]) * _MUL
    h ^= h >> np.uint64(29)
    if window == 1:
        return np.arange(len(h)), h
    if len(h) <= window:
        best = np.array([len(h) - 1 - int(np.argmin(h[::-1]))])
    else:
        view = np.lib.stride_tricks.sliding_window_view(h, window)[:, ::-1]
        best = np.unique(np.arange(len(view)) + window - 1 - np.argmin(view, axis=1))
    return best, h[best]


def band_of(n: int) -> int:
    """Diagonals on each side for a template of ``n`` words."""
    return min(BAND, max(LEAST_BAND, n // 5))


class Index:
    """Inverted index of the templates' fingerprints, one for short templates and one for the others."""

    def __init__(self, templates: dict[str, str], least: float = LEAST):
        self.names = sorted(templates)
        self.least = least
        self.words = [np.array([h for h in map(word_hash, templates[n].encode().split()) if h], np.uint64) for n in self.names]
        self.parts = []
        for short, gram, window in ((True, 2, 1), (False, GRAM, WINDOW)):
            rows = sorted((int(h), t, int(p)) for t, w in enumerate(self.words) if (len(w) < SHORT) == short for p, h in zip(*winnow(w, gram, window)))
            self.parts.append((gram, window, np.array([r[0] for r in rows], np.uint64), [(t, p) for _, t, p in rows]))

    def candidates(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(template, where it would start in the text) for each diagonal on which fingerprints meet."""
        found = set()
        for gram, window, known, place in self.parts:
            at, h = winnow(words, gram, window)
            low, high = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            found |= {(t, p - q) for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()) for t, q in place[a:b]}
        return sorted(c for c in found if self._enough(words, *c))

    def _enough(self, words: np.ndarray, t: int, start: int) -> bool:
        """Whether words enough of the template stand in the text on some diagonal of the band: no alignment matches more."""
        template = self.words[t]
        n, band = len(template), band_of(len(template))
        if min(n, len(words) - start + band) - max(0, -start - band) < self.least * n:
            return False  # the text ends before
        hit = np.zeros(n, bool)
        for at in range(start - band, start + band + 1):
            low, high = max(0, -at), min(n, len(words) - at)
            if low < high:
                hit[low:high] |= template[low:high] == words[at + low : at + high]
        return hit.sum() >= self.least * n


def align(template: np.ndarray, text: np.ndarray, start: int) -> tuple[int, int, int]:
    """(matched words, first, last + 1 matched word of the text) of the best alignment within a band of diagonals around ``start``.

    Longest common subsequence of the template and the text around it; cell (i, d) pairs template word i with text word
    start + i + d - band.  The band has BAND diagonals on each side, a fifth of the template's words if that is fewer, LEAST_BAND at least.
    """
    n = len(template)
    band = band_of(n)
    width = 2 * band + 1
    score = [0] * (width + 1)
    trace = []
    for i in range(n):
        new, how = [0] * (width + 1), []
        left = 0
        for d in range(width):
            j = start + i + d - band
            best, move = score[d + 1], 1  # the template word is left out: same text prefix, one diagonal up
            if left >= best:
                best, move = left, 2  # the text word is left out
            if 0 <= j < len(text) and template[i] == text[j] and score[d] + 1 > best:
                best, move = score[d] + 1, 3
            new[d] = left = best
            how.append(move)
        score = new
        trace.append(how)
    d = max(range(width), key=lambda k: (score[k], -abs(k - band)))
    matched, first, last, i = score[d], -1, -1, n - 1
    while i >= 0 and 0 <= d < width:
        move = trace[i][d]
        if move == 3:
            first = start + i + d - band
            last = first + 1 if last < 0 else last
            i -= 1
        elif move == 1:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return matched, first, last


def best_apart(reports: list[tuple]) -> list[tuple]:
    """Of (coverage, template, matched, start, end) the best ones that don't overlap: most words matched, less those of the template that aren't."""
    ends: list[int] = []  # of the spans taken so far, ascending, and their starts
    starts: list[int] = []
    out = []
    for r in sorted(reports, key=lambda r: (r[2] / r[0] - 2 * r[2], -r[0], r[3], r[1])):
        k = bisect_right(ends, r[3])  # the first span that ends after this one starts
        if k == len(starts) or starts[k] >= r[4]:
            starts.insert(k, r[3])
            ends.insert(k, r[4])
            out.append(r)
    return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, *, least: float = LEAST) -> DataFrame:
    """(doc_id, license, coverage, matched, start_word, end_word): the templates that a text covers to ``least`` or more."""

    if sum(len(t.split()) for t in templates.values()) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, least)
        hashes = Grown(np.uint64)
        number = WordNumbers(lambda new: hashes.extend(np.fromiter(map(word_hash, new), np.uint64, len(new))), hashes.clear)
        for batch in batches:
            rows: list[tuple] = []
            for part in chunks(batch):
                cut = [t.split() for t in texts_of(part.column("text"))]
                code = number([w for c in cut for w in c])
                code = hashes.values[code]
                end = np.cumsum([len(c) for c in cut])
                for doc, words in zip(part.column("doc_id").to_pylist(), np.split(code, end[:-1])):
                    place = np.flatnonzero(words)
                    words = words[place]
                    reports = []
                    for t, start in index.candidates(words):
                        matched, a, b = align(index.words[t], words, start)
                        if matched and matched >= least * len(index.words[t]):
                            reports.append((matched / len(index.words[t]), t, matched, int(place[a]), int(place[b - 1]) + 1))
                    rows += [(doc, index.names[r[1]], r[0], *r[2:]) for r in best_apart(reports)]
            cols = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "license", "coverage", "matched", "start_word", "end_word"])

    return narrow(docs).mapInArrow(run, "doc_id long, license string, coverage double, matched long, start_word long, end_word long")


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).withColumn("coverage", F.round("coverage", 6))
