"""Operator 1: documents whose word shingles overlap, by a MinHash LSH forest and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.graph import components
from tablesync.llm.shared import saved, texts_of, whole_rows
from tablesync.llm.words import mix, run_hashes, word_blocks

TREES = 32
LEVELS = 8
_U = np.uint64


def depths(threshold: float, recall: float, trees: int = TREES, levels: int = LEVELS) -> list[int]:
    """How many leading signature values two texts must share in each tree.

    All trees begin at full depth; the prefixes of the deepest tree are shortened by one value, again and again, until
    a pair at the threshold shares a prefix in at least one tree with the wanted probability.
    """
    depth = [levels] * trees
    while 1 - np.prod([1 - threshold**d for d in depth]) < recall:
        deepest = max(range(trees), key=lambda t: depth[t])
        if depth[deepest] == 1:
            raise ValueError(f"{trees} trees cannot reach a recall of {recall}")
        depth[deepest] -= 1
    return depth


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The distinct word n-grams of a text; a shorter text has one of all its words, one without words none."""
    if not len(hashes):
        return np.zeros(0, _U)
    return np.unique(run_hashes(hashes, min(n, len(hashes))))


def _signer(n: int, trees: int, levels: int, depth: list[int]):
    """For mapInArrow: (doc_id, text, mark) to (doc_id, key, class hash, bytes, trie nodes, mark)."""
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 1 << 31, trees * levels, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, trees * levels, dtype=np.uint32)
    salt = rng.integers(0, 1 << 63, (trees, levels), dtype=_U) * _U(2) + _U(1)
    used = np.arange(levels)[None, :] < np.array(depth)[:, None]
    salt[~used] = 0
    tree = mix(np.arange(1, trees + 1, dtype=_U))

    def signature(grams: np.ndarray) -> np.ndarray:
        low, least = grams.astype(np.uint32), None
        for k in range(0, len(low), 1024):
            part = (low[k : k + 1024, None] * odd + shift).min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, ids = batch.column(1), batch.column(0)
            for words in word_blocks(text):
                keys, marks, sizes, filled = [], [], [], []
                for k in range(words.hi - words.lo):
                    a, b = words.offsets[k], words.offsets[k + 1]
                    keys.append(hashlib.blake2b(words.normalised(k), digest_size=16).digest())
                    sizes.append(int(words.ends[b - 1] - words.starts[a]) if b > a else 0)
                    filled.append(b > a)
                    if b > a:
                        marks.append(signature(shingles(words.hashes[a:b], n)))
                filled = np.array(filled)
                nodes = np.zeros((0, trees), np.int64)
                if marks:
                    values = np.array(marks).reshape(-1, trees, levels).astype(_U)
                    nodes = mix((mix(values + _U(1)) * salt).sum(axis=2, dtype=_U) + tree).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(filled * trees)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(words.lo, words.hi - words.lo).cast(pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(np.frombuffer(b"".join(keys), np.int64)[::2]),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes.reshape(-1))),
                        batch.column(2).slice(words.lo, words.hi - words.lo),
                    ],
                    names=["doc_id", "key", "cid", "bytes", "nodes", "mark"],
                )

    return sign


_SIGNED = "doc_id long, key binary, cid long, bytes long, nodes array<long>, mark long"


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """The rows of each (part, own and other block), which arrive one after another."""
    at, rows = None, []
    for batch in batches:
        comp, i, j, own, key, weight, text = (batch.column(c) for c in ("comp", "i", "j", "own", "key", "weight", "text"))
        heads = list(zip(comp.to_pylist(), i.to_pylist(), j.to_pylist(), strict=True))
        own, key, weight = own.to_pylist(), key.to_pylist(), weight.to_pylist()
        for words in word_blocks(text):
            for k in range(words.hi - words.lo):
                r = words.lo + k
                if heads[r] != at:
                    if rows:
                        yield at, rows
                    at, rows = heads[r], []
                found = words.hashes[words.offsets[k] : words.offsets[k + 1]]
                digest = hashlib.blake2b(words.normalised(k), digest_size=16).digest()
                rows.append((own[r], key[r], weight[r], found, digest))
    if rows:
        yield at, rows


def _verifier(n: int, threshold: float):
    """For mapInArrow: exact Jaccard of all texts of a block pair that share a shingle; links counted per class."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (_, i, j), rows in _blocks_of(batches):
            # doc_id may repeat with other texts: only the class's own text counts, once
            rows = list({r[1]: r for r in rows if r[1] == r[4]}.values())
            out += _links(rows, i == j, n, threshold)
            if len(out) > 20_000:
                yield _linked(out)
                out = []
        yield _linked(out)

    return verify


def _linked(out: list[tuple]) -> pa.RecordBatch:
    key, links, root = zip(*out, strict=True) if out else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())], names=["key", "links", "root"]
    )


def _links(rows: list[tuple], inside: bool, n: int, threshold: float) -> list[tuple]:
    """(key, weight of the classes linked, key of the smallest class reached) of each class that has a link here.

    Inverted lists of shingles give every overlap; only shingles that two texts share are walked.
    """
    if len(rows) < 2:
        return []
    sets = [shingles(r[3], n) for r in rows]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(rows)), size)
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[gram] > 1
    owner, gram = owner[shared], gram[shared]
    order = np.argsort(gram, kind="stable")
    posting, ends = owner[order], np.cumsum(np.bincount(gram, minlength=len(count)))
    begins = ends - np.bincount(gram, minlength=len(count))
    mine = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))])
    block, weight = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    root, links = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    for x in range(len(rows)):
        grams = gram[mine[x] : mine[x + 1]]
        if not len(grams):
            continue
        both = np.zeros(len(rows), np.int64)
        for k in range(0, len(grams), 256):  # bounded: at most 256 lists at once
            lists = [posting[begins[g] : ends[g]] for g in grams[k : k + 256]]
            both += np.bincount(np.concatenate(lists), minlength=len(rows))
        near = both / np.maximum(size + size[x] - both, 1) >= threshold
        near[x] = False
        if not inside:
            near &= block != block[x]
        if near.any():
            links[x] = weight[near].sum()
            joined = np.unique(np.append(root[near], root[x]))
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
    keys = [r[1] for r in rows]
    return [(keys[x], int(links[x]), keys[root[x]]) for x in np.flatnonzero(links)]


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    trees: int = TREES,
    levels: int = LEVELS,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """One row per document: doc_id, key, rep_id, copies, n_links, class_id, stays.

    Documents with the same words in the same order (after lower-casing A-Z) are one text: ``key`` is its digest,
    ``rep_id`` the smallest id among its ``copies``. Two documents are linked when the Jaccard coefficient of their
    distinct word n-grams is ``threshold`` or more; ``n_links`` counts a document's links to other rows, copies included,
    and ``class_id`` is the smallest id that links lead to. ``stays`` marks one text per class (all its copies).

    Candidates come from the forest: in each tree the texts with the same prefix of their signature are one trie node;
    prefixes are as long as the wanted ``recall`` at the threshold allows (``depths``). Nodes with two or more texts join
    them into parts, every pair inside a part is verified exactly: a part is cut into blocks of ``block_bytes``, a task
    compares two blocks and returns links per text, so neither a group nor its pairs are ever gathered. A pair at the
    threshold is missed with probability 1 - ``recall``, closer pairs far less often.

    Null and empty texts, and texts without words, have no n-grams: no links, each row a class by itself (class_id is
    its own id, ``copies`` 1). A text of fewer than ``n`` words has one shingle of all of them. Repeated rows are copies.
    A null id is kept; a class of nothing but null ids has class_id null. Other columns are not looked at.
    """
    depth = depths(threshold, recall, trees, levels)
    # the mark, a hash of the raw text, finds a class's own text again where ids repeat or are null
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    signed = saved(slim.mapInArrow(_signer(n, trees, levels, depth), _SIGNED), "signatures")

    told = signed.where("bytes > 0")
    classes = told.groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("rep"),
        F.count("*").alias("copies"), F.min("cid").alias("cid"), F.max("bytes").alias("bytes"),
    )
    classes = classes.select("key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.mark").alias("rep_mark"), "copies", "cid", "bytes")
    node = told.select("cid", F.explode("nodes").alias("node"))
    crowded = node.groupBy("node").agg(F.min("cid").alias("first"), F.max("cid").alias("last")).where("first < last")
    # merged at every size: what would be broadcast here grows with the documents
    edges = node.join(crowded.hint("merge"), "node").where("cid > first").select(F.col("cid").alias("a"), F.col("first").alias("b"))
    parts = components(edges).select(F.col("node").alias("cid"), F.col("root").alias("comp"))

    inside = saved(classes.join(parts, "cid"), "candidates")
    extent = inside.groupBy("comp").agg(F.ceil(F.sum("bytes") / block_bytes).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    units = (
        inside.join(extent, "comp")
        .withColumn("own", own)
        .join(slim.hint("merge"), (F.col("rep_mark") == F.col("mark")) & F.col("rep_id").eqNullSafe(F.col("doc_id")))
        .select("comp", "own", "key", F.col("copies").alias("weight"), "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "weight", "text")
    )
    dealt = units.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    linked = saved(dealt.mapInArrow(_verifier(n, threshold), "key binary, links long, root binary"), "links")

    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(linked.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    member = groups.select(F.col("node").alias("key"), "root").join(classes.select("key", "rep_id"), "key")
    lowest = member.groupBy("root").agg(
        F.min("rep_id").alias("class_id"), F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "key")).alias("first")
    )
    grouped = member.join(lowest, "root").select("key", "class_id", (F.col("first.key") == F.col("key")).alias("stays"))
    per_text = (
        classes.select("key", "rep_id", "copies")
        .join(links, "key", "left")
        .join(grouped, "key", "left")
        .select(
            "key", "rep_id", "copies",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.when(F.col("stays").isNull(), F.col("rep_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("stays", F.lit(True)).alias("stays"),
        )
    )
    with_words = told.select("doc_id", "key").join(per_text, "key")
    out = ["doc_id", "key", "rep_id", "copies", "n_links", "class_id", "stays"]
    alone = signed.where("bytes = 0").select(
        "doc_id", "key", F.col("doc_id").alias("rep_id"), F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("stays"),
    )
    return with_words.select(*out).unionByName(alone.select(*out))


def _keyer(text_col: str):
    """For mapInArrow: add the digest of the words; null for a text without words."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for words in word_blocks(texts_of(batch, text_col)):
                for k in range(words.hi - words.lo):
                    body = words.normalised(k)
                    keys.append(hashlib.blake2b(body, digest_size=16).digest() if body else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["row", "key"])

    return keyed


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, of which ``similar_classes`` says that they stay: of each class the row with
    the smallest id, one of them if that row is repeated. Documents without words all stay."""
    judged = similar_classes(docs, id_col, text_col, **options)
    staying = judged.where(F.col("stays") & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("doc_id", "key").distinct()
    whole = docs.select(F.struct(*whole_rows(docs)).alias("row"))
    rows = whole.mapInArrow(_keyer(text_col), f"row {whole.schema['row'].dataType.simpleString()}, key binary")
    rows = rows.withColumn("id", F.col("row")[id_col].cast("long"))
    told = rows.where("key is not null").alias("r").join(
        staying.alias("s"), (F.col("r.key") == F.col("s.key")) & F.col("r.id").eqNullSafe(F.col("s.doc_id"))
    )
    once = told.select("r.row", "r.key", "r.id").dropDuplicates(["key", "id"])
    return once.select("row.*").unionByName(rows.where("key is null").select("row.*"))
