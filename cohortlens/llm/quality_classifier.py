"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w . x - t_k) with one weight vector w over hashed text features for all grades and ordered
thresholds t_0 <= t_1 <= ...  The score of a document gives its expected grade and the tail probability of reaching a chosen grade.

Defined results: a null or empty text has the score 0 (no features) and is judged by the thresholds alone; without any graded row
both columns are null and ``select_documents`` keeps every document; repeated rows are judged alike, each on its own;
extra columns pass through, but for those
that have the name of a result column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortlens.llm.common import chunks, fresh, narrow, texts_of
from cohortlens.llm.textmodel import HashedText, ascend, labelled_sample, scores, sigmoid


@dataclass(frozen=True)
class OrdinalModel:
    weight: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the lowest

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold, a column each."""
        return sigmoid(score[:, None] - self.thresholds[None, :])


def ordinal_slope(score: np.ndarray, free: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the log-likelihood of the grades ``y``: by each score, and by the free parameters (means).

    The first threshold is free, each later one adds the exponential of its parameter, so they stay ordered.
    """
    n, cuts, rows = len(y), len(free), np.arange(len(y))
    cut = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    up = np.concatenate([np.ones((n, 1)), sigmoid(score[:, None] - cut[None, :]), np.zeros((n, 1))], axis=1)
    dens = up * (1 - up)
    p = np.maximum(up[rows, y] - up[rows, y + 1], 1e-9)
    by_score = (dens[rows, y] - dens[rows, y + 1]) / p
    by_cut = np.array([np.where(y == k, dens[:, k + 1] / p, np.where(y == k + 1, -dens[:, k + 1] / p, 0)).mean() for k in range(cuts)])
    tail = np.cumsum(by_cut[::-1])[::-1]  # a step moves all later thresholds
    return by_score, np.concatenate([[tail[0]], tail[1:] * np.exp(free[1:])])


def fit(docs: DataFrame, grades: DataFrame, *, n_grades: int = 3, max_rows: int = 6000, steps: int = 120) -> OrdinalModel | None:
    """Fits the model on a sample of at most ``max_rows`` graded rows; ``grades`` is (doc_id, grade 0 .. n_grades-1).

    The bound is what the driver holds and fits; which rows it takes depends on hashed ids only.  None without graded rows.
    """
    inside = grades.where(F.col("grade").between(0, n_grades - 1))
    row, bucket, value, label = labelled_sample(docs, inside.select("doc_id", F.col("grade").cast("double").alias("label")), max_rows)
    n, y = len(label), label.astype(int)
    if not n:
        return None
    above = (y[:, None] > np.arange(n_grades - 1)[None, :]).mean(axis=0)
    start = -np.log(np.clip(above, 1e-3, 1 - 1e-3) / (1 - np.clip(above, 1e-3, 1 - 1e-3)))
    start = np.maximum.accumulate(start + np.arange(n_grades - 1) * 1e-3)

    free0 = np.concatenate([[start[0]], np.log(np.maximum(np.diff(start), 1e-3))])
    weight, free = ascend(row, bucket, value, n, lambda score, free: ordinal_slope(score, free, y), n_grades - 1, steps=steps, start=free0)
    return OrdinalModel(weight, free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))]))


def judge(docs: DataFrame, model: OrdinalModel | None, *, grade: int = 2, text: str = "text",
          names: tuple[str, str] = ("expected_grade", "tail_prob")) -> DataFrame:
    """All rows and columns of ``docs`` with the expected grade and P(grade >= ``grade``), scored in Arrow batches."""
    docs = docs.drop(*names)
    if model is None:
        return docs.withColumns({c: F.lit(None).cast("double") for c in names})
    held = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each bucket: 1 MB
    schema = StructType([*docs.schema.fields, *(StructField(c, DoubleType()) for c in names)])

    at, fields = docs.columns.index(text), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, model = HashedText(), held.value
        for batch in batches:
            alone = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string())], names=["text"])
            tails = [model.tails(scores(hashed, texts_of(part.column("text")), model.weight)) for part in chunks(alone)]
            tails = np.concatenate([np.zeros((0, len(model.thresholds))), *tails])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, grade - 1])], names=fields)

    return docs.mapInArrow(run, schema)


def select_documents(docs: DataFrame, model: OrdinalModel | None, *, grade: int = 2, least: float = 0.5) -> DataFrame:
    """The documents whose probability of reaching ``grade`` is at least ``least``, with their own columns only."""
    extra = fresh(docs, "__expected_grade", "__tail_prob")
    judged = judge(docs, model, grade=grade, names=tuple(extra))
    return judged.where(F.coalesce(F.col(extra[1]), F.lit(1.0)) >= least).drop(*extra)


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from 0/1 labels: 0 poor text, 1 good but toxic, 2 good; a row without a quality label has no grade."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, tail_prob, kept for every document."""
    model = fit(docs, grades_of(labels))
    judged = judge(narrow(docs), model)
    return judged.select("doc_id", "expected_grade", "tail_prob", (F.coalesce(F.col("tail_prob"), F.lit(1.0)) >= 0.5).alias("kept"))
