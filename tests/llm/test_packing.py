"""Packing: the ids against whole-text encoding, the laws of the pieces, and the packer against its plain form."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesync.llm.packing import Cost, pack_group, pack_sequences, piece_sizes, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "\n\n", "Hello, World.", "it's I'LL we've", "a<|endoftext|>b <|startoftext|>", "é́x É ŉ İstanbul ﬁ ß ΑΣ.", "a̸ ̸= ≮",
    "한국어 하 क्षि 日本語", "👩‍👩‍👧ok\t\ttab\r\nline\x85next wide\x1csep\x0bvt", "x" * 5000, "word " * 3000, "1234 5a6 .,. a., b,. ..", "\x00 ﻿", "aa.BB,cc ª º ƻ",
]


def encoded(text, path=PATH):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], "<u4").tobytes()


def check(pieces, texts, capacity, path=PATH):
    """All laws of the pieces of documents with distinct ids."""
    rows = pieces.collect()
    want = {i: encoded(t, path) for i, t in texts.items()}
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.doc_tokens == len(want[r.doc_id]) // 4
    assert set(docs) == set(want)
    for i, mine in docs.items():
        mine.sort(key=lambda r: r.start)
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine[:-1]]))
        assert b"".join(bytes(r.ids) for r in mine) == want[i]
    for mine in seqs.values():
        mine.sort(key=lambda r: r.offset)
        assert [r.offset for r in mine] == list(np.cumsum([0] + [r.length for r in mine[:-1]]))
        n = sum(r.length for r in mine)
        assert n == mine[0].sequence_tokens <= capacity and n & (n - 1) == 0
        assert mine[0].sequence_cost == pytest.approx(sum(Cost().of(r.length) for r in mine))
    return seqs


def plain(lengths, capacity, cost, last=True):
    """The packing rule with lists and a full sort at every step."""
    made, waiting, full = [], [], 0
    for doc, n in enumerate(lengths):
        for k in range(n // capacity):
            made.append((full, 0, doc, k * capacity, capacity))
            full += 1
        if n % capacity:
            waiting.append((n % capacity, doc, n - n % capacity))
    boxes = [[size, 0.0, 0] for size in piece_sizes(sum(w[0] for w in waiting), capacity) if last or size == capacity]
    while any(size > used for size, _, used in boxes):
        waiting.sort(key=lambda w: (-w[0], w[1], w[2]))
        n, doc, start = waiting.pop(0)
        able = [i for i, (size, _, used) in enumerate(boxes) if size - used >= n] or [i for i, (size, _, used) in enumerate(boxes) if size > used]
        best = min(able, key=lambda i: (boxes[i][1], i))
        size, _, used = boxes[best]
        take = min(n, size - used)
        made.append((full + best, used, doc, start, take))
        boxes[best][1] += cost.of(take)
        boxes[best][2] += take
        if take < n:
            waiting.append((n - take, doc, start + take))
    return sorted(made), sorted((doc, start, n) for n, doc, start in waiting)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=60), st.sampled_from([1, 4, 32, 64]), st.booleans())
def test_packer_against_its_plain_form(lengths, capacity, last):
    cost = Cost(1.0, 0.01)
    assert pack_group(lengths, capacity, cost, last) == plain(lengths, capacity, cost, last)


def test_costs_are_balanced():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 900, 3000).tolist()
    spent = {}
    for s, _, _, _, n in pack_group(lengths, 2048, Cost())[0]:
        spent.setdefault(s, [0, 0.0])
        spent[s][0] += n
        spent[s][1] += Cost().of(n)
    full = [c for n, c in spent.values() if n == 2048]
    assert max(full) / min(full) < 1.1


def test_sizes_need_no_padding():
    for total in (0, 1, 2047, 2048, 5000):
        sizes = piece_sizes(total, 2048)
        assert sum(sizes) == total and all(n & (n - 1) == 0 for n in sizes) and len(set(sizes[total // 2048 :])) == len(sizes[total // 2048 :])


def test_ids_and_laws_on_odd_texts(spark):
    texts = dict(enumerate(ODD))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, ids string, start int").repartition(2)
    check(pack_sequences(docs, PATH, capacity=64, group=4), texts, 64)


def test_documents_of_the_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    seqs = check(pack_sequences(docs.repartition(3), PATH, group=8), texts, 2048)
    assert sum(rows[0].sequence_tokens == 2048 for rows in seqs.values()) / len(seqs) > 0.8


def test_small_word_cache(spark, monkeypatch):
    import tablesync.llm.packing as module

    monkeypatch.setattr(module, "CACHED", 3)
    with open(PATH, "rb") as f:
        encode = module._encoder.__wrapped__(f.read())
    for text in ODD:
        assert encode(text or "") + np.array([1], "<u4").tobytes() == encoded(text)


def test_other_vocabularies_get_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = dict(enumerate(ODD[:10]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pack_sequences(docs, path, capacity=32, group=2), texts, 32, path)


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "some words here")] * 3 + [(1, "some words here")] * 2 + [(2, None)], "doc_id long, text string")
    rows = pack_sequences(docs, PATH, capacity=8, group=2).collect()
    n = len(encoded("some words here")) // 4
    assert sum(r.length for r in rows) == 5 * n + 1 and sum(r.length for r in rows if r.doc_id is None) == 3 * n


def test_no_documents_and_refused_parameters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_sequences(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        pack_sequences(empty, PATH, capacity=1000)


def test_sequences_and_checksums(spark):
    docs = spark.createDataFrame([(i, "some more words " * (i % 7)) for i in range(40)], "doc_id long, text string").coalesce(1)
    pieces = pack_sequences(docs, PATH, capacity=32, group=3).cache()
    whole = {r.sequence_id: r for r in sequences(pieces, 32).collect()}
    for r in pieces.withColumn("crc", F.crc32("ids")).collect():
        s = whole[r.sequence_id]
        assert bytes(s.ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids) and r.crc == zlib.crc32(bytes(r.ids))
        assert (r.doc_id, r.start, r.length) in [tuple(x) for x in s.spans] and s.tokens == r.sequence_tokens
