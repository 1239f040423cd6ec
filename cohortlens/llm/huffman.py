"""Token ids in a Huffman-coded binary format: one canonical, length-limited code from the global counts of all ids.

A dataset folder holds two Parquet tables, so that any store Spark writes to can keep it:

``code``    id, length: the canonical code.  Codes of one length are consecutive numbers in the order of the ids, shorter ones first.
``blocks``  position, start_in_task, doc_ids, n_tokens, payload, checkpoints: runs of whole documents in ascending doc_id order
            (null ids first).  Blocks are ordered by position (the task in the upper 31 bits, the number in the task below);
            start_in_task counts the ids of the task before the block.  payload is the code bits, high bit first, every document from a whole byte on;
            checkpoints are the bit offsets (unsigned 32-bit, little-endian) of every document's ids 0, EVERY, 2 * EVERY, ... in the payload.

A block can be decoded without any other one, and inside it every checkpoint starts a lane of at most EVERY ids; all lanes take one id a step
from a table that the next ``max_length`` bits index.

Tokenizing works on words: the tokenizer's pre-tokenizer never joins text across ASCII white space, so a text's ids are its words' ids in
turn, and a bounded number of words is remembered with their ids (see ``tests/llm/test_huffman.py`` for the comparison with whole texts).
Words of Latin letters go to the tokenizer's model without its normalizer and patterns where a trial of all pairs of letters shows that both give the same pieces.

Defined results: a null or empty text has only the end id; rows that share a doc_id are documents of their own, ordered by a hash of their ids; a code for
one id only has length 1; an empty table gives empty tables; other columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import Grown, WordNumbers, chunks, expand, narrow, task_of, wide
from cohortlens.session import cut_lineage, scratch_path

EVERY = 256
#: Bytes of text that are tokenized at a time: equal words of a chunk are looked up once.
CHUNK = 8 << 20
BLOCK_IDS = 1 << 18
MAX_LENGTH = 20
#: Distinct words that a worker process remembers, 170 bytes each, before it forgets the rarest ones.
WORDS = 800_000
#: Signs that may stand between words that are encoded together.
MARKS = "~|^"
#: Words of Latin letters whose pieces are known without the tokenizer's normalizer and patterns, where these lower-case letters and part them from signs.
LETTERS = [*string.ascii_letters, *(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))]
PLAIN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+[.,]?")
#: Words in one text, and texts in one call, where new words are encoded together.
IN_TEXT, TEXTS = 64, 16


# tokenizing


class Tokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids, self.start, self.count = Grown(np.uint32, 1 << 20), Grown(np.int64), Grown(np.int64)
        self.words = WordNumbers(self._learn, self._forget, 2 * WORDS)
        self.hits = np.zeros(0, np.int64)

        self.mark = next((m for m in MARKS if self._parts(m)), None)
        self.mark_id = self._encode([self.mark])[0][0] if self.mark else None
        self.quick = self._quick()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _quick(self):
        """The tokenizer's model alone, for PLAIN words, cut at spaces; none if it doesn't mark the ends of words or a pair of letters shows that it gets other pieces."""
        from tokenizers import Tokenizer, pre_tokenizers

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        normalizer, cutter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        if not suffix or not normalizer or not cutter or any(set(t.content) <= {*LETTERS, ".", ","} for t in added):
            return None
        text = " ".join([a + b for a in LETTERS for b in LETTERS] + [a + sign for a in LETTERS for sign in ".,"])
        if normalizer.normalize_str(text) != text.lower():
            return None
        pieces = [p for p, _ in cutter.pre_tokenize_str(text.lower())]
        spaces = pre_tokenizers.WhitespaceSplit()
        for own in (spaces, pre_tokenizers.Sequence([spaces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])):
            if pieces == [p for p, _ in own.pre_tokenize_str(_parted(text))]:
                quick = Tokenizer(self.tokenizer.model)
                quick.pre_tokenizer = own
                vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
                self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
                self.ends[[i for word, i in vocabulary.items() if word.endswith(suffix)]] = True
                return quick
        return None

    def _parts(self, mark: str) -> bool:
        """Whether the sign between spaces is one id of its own and leaves its neighbours' ids as they are."""
        a, m, b, joined = self._encode(["it's", mark, "b", f"it's {mark} b"])
        return len(m) == 1 and joined == a + m + b and m[0] not in a + b

    def _forget(self) -> None:
        for g in (self.ids, self.start, self.count):
            g.clear()

    def _learn(self, new: list[bytes]) -> None:
        """Ids of the words, many at a time; PLAIN ones by the model alone where that is the same."""
        plain = np.fromiter((self.quick is not None and PLAIN.fullmatch(w) is not None for w in new), bool, len(new))
        start, count = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for together, which in ((self._of_plain, np.flatnonzero(plain)), (self._of_any, np.flatnonzero(~plain))):
            for k in range(0, len(which), IN_TEXT * TEXTS):
                part = which[k : k + IN_TEXT * TEXTS]
                words = [new[i].decode() for i in part.tolist()]
                ids, n = together(words)
                if len(n) != len(words):  # one by one
                    coded = self._encode(words)
                    ids, n = np.fromiter((i for c in coded for i in c), np.uint32), np.fromiter(map(len, coded), np.int64, len(coded))
                start[part], count[part] = np.cumsum(n) - n + self.ids.n, n
                self.ids.extend(ids)
        self.start.extend(start)
        self.count.extend(count)

    def _of_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of PLAIN words and their numbers, by the ids that end a piece."""
        texts = [_parted(" ".join(words[k : k + IN_TEXT])) for k in range(0, len(words), IN_TEXT)]
        ids = np.array([i for e in self.quick.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], np.uint32)
        last = np.cumsum([1 + (w[-1] in ".,") for w in words]) - 1  # each word's last piece
        end = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(np.r_[-1, end[last]])) if len(end) == last[-1] + 1 else (ids, last[:0])

    def _of_any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words and their numbers, with the mark between the words; not all numbers if a word holds the mark."""
        if not self.mark or any(self.mark in w for w in words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        between = f" {self.mark} "
        texts = [between.join(words[k : k + IN_TEXT]) + between for k in range(0, len(words), IN_TEXT)]
        ids = np.array([i for c in self._encode(texts) for i in c], np.uint32)
        cut = np.flatnonzero(ids == self.mark_id)
        return np.delete(ids, cut), np.diff(np.r_[-1, cut]) - 1

    def _keep_frequent(self) -> None:
        """Forgets the rarest words, at least half of what may be remembered; the others keep their ids without being encoded again."""
        most = np.sort(self.hits)[-(WORDS // 2)]
        keep = np.flatnonzero(self.hits > most)
        words = list(self.words.number)
        start, count = self.start.values[keep], self.count.values[keep]
        ids = self.ids.values[expand(start, count)]
        self._forget()
        self.words.number.clear()
        self.words.number.update((words[k], n) for n, k in enumerate(keep.tolist()))
        self.ids.extend(ids)
        self.start.extend(np.cumsum(count) - count)
        self.count.extend(count)
        self.hits = self.hits[keep]

    def __call__(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        if len(self.words.number) > WORDS:
            self._keep_frequent()
        cut = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))  # leaves empty words at the ends of a text
        cells = cut.flatten().dictionary_encode()
        words = cells.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        code = self.words(words)[cells.indices.to_numpy()]
        hits = np.bincount(code, minlength=len(self.words.number))
        hits[: len(self.hits)] += self.hits
        self.hits = hits
        count = self.count.values[code]
        ids = self.ids.values[expand(self.start.values[code], count)]
        n = pc.fill_null(pc.list_value_length(cut), 0).to_numpy()
        ends = np.cumsum(np.r_[0, count])[np.cumsum(n)]
        return np.split(ids, ends[:-1]) if len(n) else []


def _parted(text: str) -> str:
    """Lower-cased, with spaces before signs."""
    return text.lower().replace(".", " .").replace(",", " ,")


@functools.cache
def tokens_of(path: str) -> Tokens:
    """The tokenizer and what it has learned, kept by the worker process from task to task."""
    return Tokens(path)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(doc_id, h, ids, counts) for each row: a hash of its ids, and its ids and the end id as little-endian unsigned 32-bit integers; and a row without ids for
    each task, with the task's numbers of ids 0, 1, ... (little-endian 64-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, total = tokens_of(tokenizer), np.uint32(end_id).tobytes(), np.zeros(end_id + 1, np.int64)
        names = ["doc_id", "h", "ids", "counts"]
        for batch in batches:
            for part in chunks(batch, size=CHUNK):
                found = tokens(part.column("text"))
                n = np.bincount(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64), minlength=len(total))
                n[: len(total)] += total
                n[end_id] += part.num_rows
                total = n
                ids = [x.astype("<u4").tobytes() + end for x in found]
                h = np.array([xxhash.xxh3_64_intdigest(x) for x in ids], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(h), pa.array(ids, pa.binary()), pa.nulls(part.num_rows, pa.binary())], names=names)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    return narrow(docs).mapInArrow(run, "doc_id long, h long, ids binary, counts binary")


# code


def code_lengths(counts: np.ndarray, max_length: int = MAX_LENGTH) -> np.ndarray:
    """Optimal code lengths of at most ``max_length`` bits for symbols with these counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_length:
        raise ValueError(f"{n} symbols have no code of {max_length} bits")
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_length):
        merged = np.concatenate([weight, packages])
        place = np.argsort(merged, kind="stable")
        levels.append(place < n)
        merged = merged[place]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(levels):
        singles = int(single[:take].sum())
        length[:singles] += 1
        take = 2 * (take - singles)
    out = np.empty(n, np.int64)
    out[order] = length
    return out


def canonical(length: np.ndarray) -> np.ndarray:
    """The code of each symbol, given the lengths in the order of the symbols."""
    code, out, last = 0, np.zeros(len(length), np.uint64), 0
    for i in np.lexsort((np.arange(len(length)), length)).tolist():
        code <<= int(length[i]) - last
        out[i], last = code, int(length[i])
        code += 1
    return out


class Code:
    def __init__(self, ids: np.ndarray, length: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.length = ids[order].astype(np.int64), length[order].astype(np.int64)
        self.code = canonical(self.length)
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.code, self.length

    def table(self) -> tuple[int, np.ndarray, np.ndarray]:
        """(bits, id, length) for every value of the next bits."""
        bits = int(self.length.max()) if len(self.length) else 1
        ids, length = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
        first = (self.code << (bits - self.length).astype(np.uint64)).astype(np.int64)
        order = np.argsort(first)
        spread = (1 << (bits - self.length))[order]
        covered = int(spread.sum())
        ids[:covered], length[:covered] = np.repeat(self.ids[order], spread), np.repeat(self.length[order], spread)
        return bits, ids, length

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of one document, filled to whole bytes, and its checkpoints."""
        length = self.length_of[ids]
        end = np.cumsum(length)
        start = end - length
        total = int(end[-1]) if len(ids) else 0
        value = self.code_of[ids] << (64 - (start & 31) - length).astype(np.uint64)  # two 32-bit words hold a code
        word = start >> 5
        edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(ids) else np.zeros(0, np.int64)
        out = np.zeros(total // 32 + 2, np.uint64)
        if len(ids):
            out[word[edge]] += np.add.reduceat(value >> np.uint64(32), edge)
            out[word[edge] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), edge)
        return out.astype(">u4").tobytes()[: (total + 7) // 8], start[::EVERY].astype(np.uint32)


def decode(table: tuple[int, np.ndarray, np.ndarray], payload: bytes, checkpoints: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
    """All ids of a block, document after document."""
    bits, ids, length = table
    data = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    ahead = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    lanes = -(-n_tokens // EVERY)
    count = np.full(int(lanes.sum()), EVERY, np.int64)  # ids of a lane
    last = np.cumsum(lanes) - 1
    count[last] = n_tokens - (lanes - 1) * EVERY
    order = np.argsort(-count, kind="stable")
    at, to, left = checkpoints.astype(np.int64)[order], (np.cumsum(count) - count)[order], count[order]
    active = np.searchsorted(-left, -np.arange(EVERY), side="left")  # lanes with more ids than the step
    out = np.zeros(int(n_tokens.sum()), np.uint32)
    for step in range(EVERY):
        k = int(active[step])
        if not k:
            break
        p = at[:k]
        index = (ahead[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - bits)
        out[to[:k] + step] = ids[index]
        at[:k] = p + length[index]
    return out


# the dataset


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 1, max_length: int = MAX_LENGTH) -> None:
    """Tokenizes all texts and writes the dataset to ``path``; ``max_length`` is at most 24."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    tokenize(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(folder)
    written = spark.read.schema("doc_id long, h long, ids binary, counts binary").parquet(folder)
    tokens = written.where("counts IS NULL").select("doc_id", "h", "ids")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                n = np.frombuffer(x, "<i8")
                ids = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[ids])], names=["id", "n"])

    counts = written.where("counts IS NOT NULL").select("counts").mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # a row for each id of the vocabulary
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(ids)
    code = Code(ids[order], code_lengths(n[order], max_length))
    spark.createDataFrame(pa.table({"id": code.ids, "length": code.length.astype(np.int32)})).coalesce(1).write.mode("overwrite").parquet(f"{path}/code")
    held = spark.sparkContext.broadcast(code)  # bounded by the vocabulary

    # where the tasks of the global order begin, from ids and hashes alone: a range partitioning of the code itself would encode everything twice
    first = tokens.select("doc_id", "h").repartitionByRange(wide(docs), "doc_id", "h").groupBy(F.spark_partition_id()).agg(F.min(F.struct("doc_id", "h")).alias("at"))
    begins = sorted((r["at"]["doc_id"] is not None, r["at"]["doc_id"] or 0, r["at"]["h"]) for r in first.collect())  # one for each task

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(len(x) // 4, *held.value.encode(np.frombuffer(x, "<u4"))) for x in batch.column("ids").to_pylist()]
            task = [max(bisect.bisect_right(begins, (i is not None, i or 0, h)) - 1, 0) for i, h in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(task, pa.int32()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary()),
                 pa.array([g[2].tobytes() for g in got], pa.binary())], names=["doc_id", "h", "task", "n", "payload", "checkpoints"])

    coded = tokens.mapInArrow(encode, "doc_id long, h long, task int, n long, payload binary, checkpoints binary")
    coded = coded.repartitionById(max(len(begins), 1), "task").sortWithinPartitions("doc_id", "h").select("doc_id", "n", "payload", "checkpoints")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = size = 0
        rows: list[tuple] = []

        def block() -> pa.RecordBatch:
            offset = np.cumsum([0, *(len(r[2]) for r in rows)]) * 8
            if offset[-1] >= 1 << 32:
                raise ValueError(f"the code of document {rows[-1][0]} is too long for bit offsets of 32 bits (512 MB a block)")
            points = [np.frombuffer(r[3], np.uint32) + np.uint32(o) for r, o in zip(rows, offset)]
            return pa.RecordBatch.from_arrays(
                [pa.array([start]), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
                 pa.array([b"".join(r[2] for r in rows)], pa.binary()), pa.array([np.concatenate(points).astype("<u4").tobytes()], pa.binary())],
                names=["start_in_task", "doc_ids", "n_tokens", "payload", "checkpoints"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "payload", "checkpoints"))):
                rows.append(row)
                size += row[1]
                if size >= BLOCK_IDS:
                    yield block()
                    start, size, rows = start + size, 0, []
        if rows:
            yield block()

    blocks = coded.mapInArrow(pack, "start_in_task long, doc_ids array<long>, n_tokens array<long>, payload binary, checkpoints binary")
    blocks = blocks.withColumn("position", F.monotonically_increasing_id())
    blocks.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this module has written, on whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


BLOCKS = "start_in_task long, doc_ids array<long>, n_tokens array<long>, payload binary, checkpoints binary, position long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document's ids (little-endian unsigned 32-bit), decoded from the dataset.

    start counts the ids of all documents before it.
    """
    known = spark.read.schema("id long, length int").parquet(f"{path}/code").toArrow()
    held = spark.sparkContext.broadcast(Code(known.column("id").to_numpy(), known.column("length").to_numpy()).table())
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    tasks = blocks.groupBy(task_of("position").alias("task")).agg(F.max(F.col("start_in_task") + size).alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote
    tasks = cut_lineage(tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "token-tasks")
    placed = blocks.join(F.broadcast(tasks), task_of("position") == F.col("task"))
    placed = placed.select((F.col("before") + F.col("start_in_task")).alias("start"), "doc_ids", "n_tokens", "payload", "checkpoints")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            for row in range(batch.num_rows):
                start, docs, n, payload, points = (batch.column(c)[row] for c in ("start", "doc_ids", "n_tokens", "payload", "checkpoints"))
                n = n.values.to_numpy()
                ids = decode(table, payload.as_py(), np.frombuffer(points.as_py(), "<u4"), n).astype("<u4").tobytes()
                end = np.cumsum(n)
                cells = [ids[4 * a : 4 * b] for a, b in zip((end - n).tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(end - n + start.as_py()), pa.array(n), pa.array(cells, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of each document's ids, from the written and read dataset."""
    path = path or scratch_path(docs.sparkSession, "huffman")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
