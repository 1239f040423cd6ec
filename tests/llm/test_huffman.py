import heapq
import os
import zlib

import numpy as np
import public_tokenizers
import pytest

from cohortlens.llm import huffman

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts, path=PATH):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return [e.ids + [1] for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts():
    odd = ["", " ", "It's  John's\tCAFÉ\x0b don't", "a\u00a0b \u2003c\x1cd\x85e", "x<|endoftext|>y <|startoftext|>", "e\u0301 \u0301a ﬁ Ⅷ ½", "İstanbul ΣΑΣ", "👩‍👩‍👧 ok 中文字 12345",
           "\u0130\u0307 I\u0300\n\n.. !!'s 'll", "a" * 3000, "ü" * 500 + " ñ", "~ a ~~ b~c ~", "| ^ ~", "~"]
    got = huffman.Tokens(PATH)([t.encode() for t in odd])
    assert [g.tolist() + [1] for g in got] == whole(odd)


def test_words_of_latin_letters_go_to_the_model_alone():
    tokens = huffman.Tokens(PATH)
    assert tokens.quick is not None
    texts = ["Ünïon, Straße. ÀÉÿ þorn×two÷three ÆŒ don't. stop.. a, .b", " ".join(a + b + c for a in "aZÖß" for b in "xÉ\u0301" for c in ("", ".", ",", ".,", "'s"))]
    texts += [" ".join(f"Wört{k}, wort{chr(97 + k % 26) * (k % 40)}." for k in range(3000)), "</w> a</w>b", "i\u0307 İx"]
    assert [g.tolist() + [1] for g in tokens([t.encode() for t in texts])] == whole(texts)


def test_forgetting_rare_words_keeps_the_ids(prose, monkeypatch):
    monkeypatch.setattr(huffman, "WORDS", 60)
    tokens = huffman.Tokens(PATH)
    texts = [t for _, t in prose]
    for k in range(0, len(texts), 7):
        got = tokens([t.encode() for t in texts[k : k + 7]])
        assert [g.tolist() + [1] for g in got] == whole(texts[k : k + 7])
    assert len(tokens.words.number) == len(tokens.hits) == len(tokens.start.values)


@pytest.mark.parametrize("n,limit", [(1, 20), (2, 20), (7, 3), (300, 9), (4000, 16)])
def test_code_is_prefix_free_limited_and_round_trips(n, limit):
    rng = np.random.default_rng(n)
    length = huffman.code_lengths((rng.pareto(0.6, n) * 9 + 1).astype(np.int64), limit)
    assert length.max() <= limit and (n == 1 or (2.0**-length).sum() == 1.0)
    ids = np.sort(rng.choice(60_000, n, replace=False))
    code = huffman.Code(ids, length)
    docs = [ids[rng.integers(0, n, k)] for k in (1, 255, 256, 257, 3000)]
    payload, points = b"", []
    for d in docs:
        bits, at = code.encode(d)
        points.append(at + 8 * len(payload))
        payload += bits
    out = huffman.decode(code.table(), payload, np.concatenate(points), np.array([len(d) for d in docs]))
    assert (out == np.concatenate(docs)).all()


def test_lengths_are_huffman_lengths_where_the_limit_does_not_bind():
    counts = np.array([5, 9, 12, 13, 16, 45, 1, 1, 3])
    heap = [(int(c), k, 0) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 100 + cost, 0))
    assert int((huffman.code_lengths(counts, 12) * counts).sum()) == cost


def test_dataset_against_whole_texts(spark, prose, prose_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 500)
    path = f"file://{tmp_path}/ids"
    got = sorted(huffman.digest(prose_docs, PATH, path).collect())
    start = 0
    for r, ids in zip(got, whole([t for _, t in prose])):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("position").collect()
    assert [d for b in blocks for d in b.doc_ids] == [i for i, _ in prose]  # ascending, whole documents
    one = blocks[1]  # decoded on its own
    code = spark.read.parquet(f"{path}/code").toPandas()
    table = huffman.Code(code.id.to_numpy(), code.length.to_numpy()).table()
    ids = huffman.decode(table, bytes(one.payload), np.frombuffer(bytes(one.checkpoints), "<u4"), np.array(one.n_tokens))
    texts = dict(prose)
    assert ids.tolist() == [i for x in whole([texts[d] for d in one.doc_ids]) for i in x]


def test_odd_rows(odd):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens) for r in huffman.digest(odd, PATH).collect()))
    assert len(rows) == 10 and rows[0][2] == 0 and not rows[0][0]  # the null id comes first
    assert [r[2] for r in rows] == np.cumsum([0, *(r[3] for r in rows[:-1])]).tolist()
    assert {r[1]: r[3] for r in rows if r[1] in (2, 3, 4)} == {2: 1, 3: 1, 4: 1}
    assert huffman.digest(odd.limit(0), PATH).collect() == []
