"""The similarity join against all pairs."""

import random
from collections import Counter

import pytest
from test_words import split

from tablesync.llm.near import depths, one_per_class, similar_classes

SCHEMA = "doc_id long, text string, key string, nodes int"


def brute(docs, n=5, threshold=0.8):
    """n_links and the smallest id of the component, by row."""
    sets = []
    for _, text, *_ in docs:
        w = split(text)
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = Counter()
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    lowest = {}
    for i in range(len(docs)):
        lowest[root(i)] = min((x for x in (lowest.get(root(i)), docs[i][0]) if x is not None), default=None)
    return sorted((docs[i][0], links[i], lowest[root(i)]) for i in range(len(docs)))


def corpus(seed=1, groups=8, most=25):
    """Groups of texts with a few words changed, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    docs, boiler = [], [word() for _ in range(30)]
    for _ in range(groups):
        base = [word() for _ in range(rng.choice((3, 8, 60, 150)))]
        for _ in range(rng.randrange(1, most)):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                w = boiler + w
            docs.append((len(docs), rng.choice((" ", ", ")).join(w).title() if rng.random() < 0.2 else " ".join(w), "k", 1))
    return docs


@pytest.mark.parametrize("block_bytes", [2 << 20, 2000])
def test_links_and_classes(rows, block_bytes):
    docs = corpus()
    got = similar_classes(rows(docs, SCHEMA), block_bytes=block_bytes)
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got.collect()) == brute(docs)


def test_edges(rows):
    long = " ".join(str(k) for k in range(60_000))
    docs = [
        (1, None, "", 0), (2, "", "", 0), (3, " -- ", "", 0), (4, "two words", "", 0), (5, "Two, words!", "", 0), (6, "two words more", "", 0),
        (7, long, "", 0), (8, long + " end", "", 0), (8, long + " end", "", 0), (9, "a b c d e", "", 0), (9, "v w x y z", "", 0),
    ]
    got = similar_classes(rows(docs, SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_links, r.class_id) for r in got) == brute(docs)
    assert {r.doc_id: r.copies for r in got if r.doc_id in (1, 4, 8)} == {1: 1, 4: 2, 8: 2}


def test_null_ids(rows):
    docs = [(None, "one two three four five six", "", 0), (None, "One two three four five six", "", 0), (3, "one two three four five six", "", 0), (None, "other", "", 0)]
    got = similar_classes(rows(docs, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.n_links, r.class_id) for r in got), key=str) == sorted([(None, 2, 3), (None, 2, 3), (3, 2, 3), (None, 0, None)], key=str)
    assert one_per_class(rows(docs, SCHEMA)).count() == 2


def test_no_documents(rows):
    assert similar_classes(rows([], SCHEMA)).count() == 0
    assert one_per_class(rows([], SCHEMA)).columns == ["doc_id", "text", "key", "nodes"]


def test_one_row_of_each_class_stays(rows):
    docs = corpus(5) + [(1000, None, "x", 2), (1001, "", "y", 3), (0, corpus(5)[0][1], "k", 1)]
    got = one_per_class(rows(docs, SCHEMA)).collect()
    want = {c for i, _, c in brute(docs)}
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert got[0].asDict().keys() == {"doc_id", "text", "key", "nodes"}


def test_prefixes_are_shortened_until_the_recall_is_reached():
    some = depths(0.8, 0.9999)
    missed = 1.0
    for d in some:
        missed *= 1 - 0.8**d
    assert 1 - missed >= 0.9999
    longer = sorted(some, reverse=True)
    longer[-1] += 1
    missed = 1.0
    for d in longer:
        missed *= 1 - 0.8**d
    assert 1 - missed < 0.9999
    assert max(depths(0.95, 0.9)) == 8
    with pytest.raises(ValueError):
        depths(0.1, 0.99999, trees=2)


def test_many_null_ids_do_not_multiply(spark):
    """A third of the rows without an id: each class still meets its own text only."""
    from pyspark.sql import functions as F

    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.concat(F.lit("w"), (F.col("id") * 31 + k).cast("string"))), " ")
    docs = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), words.alias("text"))
    near = docs.select("doc_id", F.concat("text", F.lit(" end")).alias("text"))
    got = similar_classes(docs.unionByName(near))
    assert got.where("n_links = 1").count() == 1800 and got.where("class_id is null").count() == 600
