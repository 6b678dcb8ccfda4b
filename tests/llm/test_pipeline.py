"""Every stage on its own input against a plain form of its operator; the whole run."""

from collections import Counter

import corpus_pipeline as P
import pytest
import test_decontaminate
import test_near

from tablesync.llm import quality as Q
from tablesync.llm.mixing import mix

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The input of each stage, and the last one's result."""
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_are_those_dealt(kept):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    for df in kept[:-1]:
        assert df.columns == COLUMNS
    assert all(df.count() for df in kept)


def test_quality_rejects_what_the_score_says(spark, kept):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = Q.score(kept[0], Q.fit(kept[0], labels)).collect()
    assert ids(kept[1]) == Counter(r.doc_id for r in scored if r.predicted == 1)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    assert not [i for i in ids(kept[0]) if marks.get(i) == 1 and not ids(kept[1])[i]]


def test_one_of_each_group_stays(kept):
    assert ids(kept[2]) == Counter({c for _, _, c in test_near.brute(rows_of(kept[1]))})


def test_contaminated_documents_go(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert ids(kept[3]) == Counter(x[0] for x in test_decontaminate.brute(rows_of(kept[2]), items) if not x[5])


def test_documents_are_repeated_as_taken(kept):
    assert ids(kept[4]) == Counter({r.doc_id: r.copies for r in mix(kept[3]).collect() if r.copies})


def test_every_row_gets_a_shard(kept):
    got = kept[5].collect()
    assert ids(kept[5]) == ids(kept[4])
    assert kept[5].columns[:5] == COLUMNS
    for s in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_run_is_the_stages_one_after_another(spark, kept):
    got = P.run(spark, FOLDER)
    assert sorted((r.doc_id, r.shard, r.slot) for r in got.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in kept[5].collect())
    assert P.ORACLE_SQL is None


def test_other_columns_and_no_documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, key int, size int, score int"
    data = [(k, f"some words of document {k} and more of them", "en", "a", 1, "x", k, k, k) for k in range(30)]
    for docs in (rows(data, schema), rows([], schema)):
        names = docs.columns
        for k, (_, stage) in enumerate(P.STAGES):
            docs = stage(spark, docs, FOLDER)
            if k < 4:
                assert docs.columns == names
        assert len(set(docs.columns)) == len(docs.columns)
        docs.count()


def test_sharding_keeps_columns_it_does_not_add(spark, rows):
    data = [(k, f"some words of document {k}", k * 7, f"g{k}") for k in range(30)]
    got = P.sharding(spark, rows(data, "doc_id long, text string, tokens int, grown_shard string"), FOLDER)
    assert got.columns == ["doc_id", "text", "tokens", "grown_shard", "size", "text_crc32", "law", "shard", "slot"]
    assert sorted(tuple(r)[:4] for r in got.collect()) == data
