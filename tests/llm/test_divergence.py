"""Divergence of sources against a plain form over dictionaries."""

import random
import re
from collections import Counter

from conftest import values

from tablesync.llm.divergence import divergence

SCHEMA = "text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_df, top=10):
    docs = [[x or "" for x in d] for d in docs]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)) for t, _, _ in docs]
    out = []
    for lang in {la for _, la, _ in docs}:
        mine = [(w, s) for w, (_, la, s) in zip(words, docs, strict=True) if la == lang]
        df = Counter(t for w, _ in mine for t in set(w))
        kept = sorted((t for t, n in df.items() if n >= min_df), key=str.encode)
        counts = {s: Counter() for _, s in mine}
        for w, s in mine:
            counts[s].update(w)

        def shares(c):
            total = sum(c[t] for t in kept)  # noqa: B023
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}  # noqa: B023

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, rows, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                rows.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(rows[:limit])]
    return sorted(out)


def made(n=400, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["the", "Été", "été", "日本", "x", "straße", "I", "i", "naïve", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8))]
    docs = []
    for k in range(n):
        text = " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30))) + rnd.choice(["", ".", "\n1a2b", "ABC-d"])
        lang = rnd.choice(["en", "en", "en", "de", None, ""])
        docs.append((text if k % 17 else None, lang, rnd.choice(["hot", "hot", *"abcdefg", None])))
    return docs + [("", "xx", "only"), (None, "xx", "empty"), ("lonely words here", "xx", "only"), ("just one", "yy", "one")]


def frame(spark, docs):
    return spark.createDataFrame(docs, SCHEMA).repartition(3).withColumn("term", spark_lit("clash")).withColumn("n", spark_lit(5))


def spark_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_dictionaries(spark):
    docs = made()
    assert got(divergence(frame(spark, docs), min_df=5)) == plain(docs, 5)


def test_vocabulary_in_slices(spark):
    docs = made(150)
    assert got(divergence(frame(spark, docs), min_df=3, slice_terms=30)) == plain(docs, 3)


def test_many_pieces_blocks_and_batches(spark, monkeypatch):
    """Small bounds: pair tables of several blocks that are handed out early, cells in several steps."""
    import tablesync.llm.divergence as module

    docs = made(200, seed=9)
    want = plain(docs, 3)
    monkeypatch.setattr(module, "ROWS_PER_PIECE", 20)
    assert got(divergence(frame(spark, docs), min_df=3)) == want
    from tablesync.llm.divergence import _Language

    monkeypatch.setattr(module, "SOURCES", 3)
    monkeypatch.setattr(module, "TABLES", 2)
    monkeypatch.setattr(module, "CELLS", 7)
    import numpy as np

    rnd = random.Random(1)
    names = [f"s{i}" for i in range(8)]
    counts = {(t, s): rnd.randint(1, 9) for t in range(12) for s in range(8) if rnd.random() < 0.5}
    sizes = [sum(n for (_, s), n in counts.items() if s == g) for g in range(8)]
    language = _Language("l", [(n, z, 12) for n, z in zip(names, sizes, strict=True)], 3)
    rows = list(language.base(0, 2)) + list(language.base(1, 2))
    keys = sorted(counts)
    columns = [np.array(c, np.int64) for c in ([t for t, _ in keys], [s for _, s in keys], [counts[k] for k in keys])]
    rows += list(language.add(*columns, [f"t{t:02}" for t in range(12)]))
    rows += list(language.pairs())
    total = Counter()
    for _, _, a, b, v in rows:
        total[a, b] += v
    p = [[1 + 10**9 * (counts.get((t, s), 0) + 2) // (sizes[s] + 24) for t in range(12)] for s in range(8)]
    for a in range(8):
        for b in range(8):
            if a != b:
                assert total[names[a], names[b]] == sum((x - y) ** 2 // (x + y) for x, y in zip(p[a], p[b], strict=True))


def test_counts_beyond_a_long_when_scaled():
    import numpy as np

    from tablesync.llm.divergence import _shares

    assert _shares(np.array([10**15, 0]), 2 * 10**15, 3).tolist() == [1 + 10**9 * (10**15 + 2) // (2 * 10**15 + 6), 1]


def test_long_text_repeated_rows_and_ties(spark):
    docs = [("same words " * 50_000, "en", "a")] * 2 + [("other words", "en", "b")] * 3 + [("same other", "en", "c")] * 2
    assert got(divergence(frame(spark, docs), min_df=2)) == plain(docs, 2)


def test_no_term_kept_and_no_documents(spark):
    docs = [("a b c", "en", "x"), ("d", "en", "y"), ("e", "de", "z")]
    assert got(divergence(frame(spark, docs))) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    empty = divergence(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and values(empty) == []
