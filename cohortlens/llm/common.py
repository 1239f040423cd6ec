"""Shared helpers of the corpus operators.

Texts are cut into words at the six ASCII white-space characters (space and 0x09-0x0D).  In Python,
``bytes.split()`` cuts at exactly these; in SQL, ``WORD`` is the pattern.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage, scratch_path, table_path

#: A word: a run without the six ASCII white-space characters (also a DuckDB pattern).
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python worker takes at a time within an Arrow batch.
CHUNK_BYTES = 2 << 20
#: Distinct words a worker remembers before it starts afresh.
MAX_WORDS = 150_000
#: Rows of a key from which it is hot, and rows of a table of keys that may be broadcast.
HOT_ROWS, MOST_NAMED = 100_000, 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def wide(df: DataFrame) -> int:
    """Number of tasks for an explicit range partitioning: what the session uses for shuffles."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def narrow(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Only the two columns an operator reads, as (doc_id long, text string); extra columns may have any name."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [t or b"" for t in column.to_pylist()]


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text; a single longer text is one slice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(edges):
        if b > a:
            yield batch.slice(a, b - a)


class WordNumbers:
    """Numbers the distinct words it meets; ``info(new words)`` is asked once for each word."""

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None], most: int = MAX_WORDS):
        self.learn, self.forget, self.most = learn, forget, most
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = _Counting()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > self.most:
            self._reset()
            self.forget()
        before = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        fresh = len(self.number) - before
        if fresh:
            new = list(itertools.islice(reversed(self.number), fresh))
            new.reverse()
            self.learn(new)
        return out


class _Counting(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, dtype: type, size: int = 1 << 16):
        self.data, self.n = np.zeros(size, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            data = np.zeros(max(need, 2 * len(self.data)), self.data.dtype)
            data[: self.n] = self.data[: self.n]
            self.data = data
        self.data[self.n : need] = values
        self.n = need

    def clear(self) -> None:
        self.n = 0

    @property
    def values(self) -> np.ndarray:
        return self.data[: self.n]


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, run after run."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (column names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Helper columns under their final names; a column of ``df`` that has such a name already gives way."""
    return df.drop(*names.values()).withColumnsRenamed(names)


def small(df: DataFrame, most: int, name: str) -> DataFrame:
    """``df``, written once; marked for a broadcast if it has at most ``most`` rows, else left to a shuffled join."""
    df = cut_lineage(df, name)
    return F.broadcast(df) if df.count() <= most else df


def join_hot(rows: DataFrame, named: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``named``, which has each key once and in ``copies`` the number of rows with it.

    A small ``named`` is broadcast.  Else the keys of more than ``HOT_ROWS`` rows are (there are at most rows / HOT_ROWS of them), and only the other rows are
    shuffled, so no task gets more than HOT_ROWS rows for one key.  Keys of ``rows`` have no nulls.
    """
    named = cut_lineage(named, "join-named")
    if named.count() <= MOST_NAMED:
        return rows.join(F.broadcast(named), keys, how)
    hot = cut_lineage(named.where(F.col("copies") > HOT_ROWS), "join-hot")
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(named.where(F.col("copies") <= HOT_ROWS), keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def ordered(df: DataFrame, order: list[Column], position: str, name: str) -> DataFrame:
    """``df`` in one global order, written once; ``position`` has the task in its upper 31 bits and the row in its lower 33.

    Rows are dealt by range, so rows equal in some keys are split by the next ones and no key meets in one task.
    """
    dealt = df.repartitionByRange(wide(df), *order).sortWithinPartitions(*order)
    path = scratch_path(df.sparkSession, name)
    dealt.withColumn(position, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def task_of(position: str) -> Column:
    return F.shiftright(F.col(position), 33)


def row_of(position: str) -> Column:
    return F.col(position).bitwiseAND(F.lit((1 << 33) - 1))
