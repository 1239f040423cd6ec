"""Quality rules: counts over the whole text, and a calibrated logistic regression on hashed words and character trigrams.

The regression is fitted on a bounded sample of labelled rows, four fifths for the weights and one fifth for the calibration (a
logistic of the raw score), and scored in Arrow batches against a fixed threshold of the calibrated probability.

Defined results: a null or empty text has no word and fails the base rules; without labelled rows of both
classes the model accepts every text; repeated rows are judged alike; an empty table gives an empty table; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from cohortlens.llm.common import WordNumbers, chunks, narrow, texts_of
from cohortlens.llm.textmodel import HashedText, ascend, labelled_sample, scores, sigmoid

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, LEAST = 50, 50, 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class LogisticModel:
    weight: np.ndarray
    bias: float
    slope: float  # of the calibration
    shift: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (score + self.bias) + self.shift)


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = 6000, steps: int = 120) -> LogisticModel | None:
    """Fits on at most ``max_rows`` labelled rows (doc_id, quality 0/1), chosen by hashed id; None without both classes."""
    chosen = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("double").alias("label"))
    row, bucket, value, y = labelled_sample(docs, chosen, max_rows)
    n = len(y)
    held = np.arange(n) % 5 == 4
    if len(set(y[~held].tolist())) < 2:
        return None
    known = ~held[row]

    def slope(score: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wrong = np.where(held, 0.0, y - sigmoid(score + bias[0]))
        return wrong, np.array([wrong.mean()])

    weight, bias = ascend(row[known], bucket[known], value[known], n, slope, 1, steps=steps)
    score = np.bincount(row, weights=weight[bucket] * value, minlength=n)[held] + bias[0]
    return LogisticModel(weight, float(bias[0]), *_calibrate(score, y[held]))


def _calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic of the score, with the smoothed targets of Platt's method; (1, 0) without both classes."""
    good, bad = int((y > 0).sum()), int((y <= 0).sum())
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([score, np.ones(len(score))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps, damped by a small ridge towards (1, 0)
        p = sigmoid(x @ b)
        g = x.T @ (target - p) - 1e-2 * (b - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b + step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
    return float(max(b[0], 1e-3)), float(b[1])


_NOT_A_START = np.zeros(256, np.int64)
_NOT_A_START[0x80:0xC0] = 1
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)]).astype(np.int64)
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS)).astype(np.int64)


def repeated(code: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(code) < 4:
        return 0
    if code.max() >= 1 << 21:
        code = np.unique(code, return_inverse=True)[1]
    if code.max() < 1 << 21:
        window = (code[:-2] << 42) | (code[1:-1] << 21) | code[2:]
    else:  # over two million different words in one text
        pair = np.unique(code[:-2] * len(code) + code[1:-1], return_inverse=True)[1]
        window = pair * len(code) + code[2:]
    _, place, times = np.unique(window, return_inverse=True, return_counts=True)
    twice = times[place] > 1
    hit = np.zeros(len(code), bool)
    for k in range(3):
        hit[k : len(code) - 2 + k] |= twice
    return int(hit.sum())


def base_counts(texts: list[bytes], number: WordNumbers) -> np.ndarray:
    """A row of COUNTS for each text."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    cut = [t.split() for t in texts]
    code = number([w for c in cut for w in c])
    end = 0
    for k, (text, words) in enumerate(zip(texts, cut)):
        flat = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        start, end = end, end + len(words)
        out[k] = (len(words), len(text) - flat @ _NOT_A_START - flat @ _SPACE, flat @ _SYMBOL, len(lines) - len(set(lines)),
                  repeated(code[start:end]))
    return out


def judge(docs: DataFrame, model: LogisticModel | None, *, least: float = LEAST) -> DataFrame:
    """(doc_id, COUNTS, base_failed, quality_prob, kept) of each document."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each bucket: 1 MB
    schema = StructType([StructField("doc_id", LongType()), *(StructField(c, LongType()) for c in COUNTS), StructField("base_failed", BooleanType()),
                         StructField("quality_prob", DoubleType()), StructField("kept", BooleanType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, model = HashedText(), held.value
        number = WordNumbers(lambda new: None, lambda: None)
        for batch in batches:
            for part in chunks(batch):
                texts = texts_of(part.column("text"))
                counts = base_counts(texts, number)
                failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
                prob = model.probability(scores(hashed, texts, model.weight)) if model else np.ones(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(prob),
                     pa.array(~failed & (prob >= least))], names=names)

    return narrow(docs).mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, fit(docs, labels))
