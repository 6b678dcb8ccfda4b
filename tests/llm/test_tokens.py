import base64
from collections import Counter

import tiktoken
from conftest import values

from tablesync.llm.queries import token_batches
from tablesync.llm.tokens import BYTE_PAIRS, PATTERN, VOCABULARY, WORDS, Rollup, count_tokens, deletes, inserts, revisions

SCHEMA = "doc_id long, text string, source string, lang string, tokens int, tokenizer int"
DOCS = [
    (1, "One  two\tthree\n", "a", "en", 0, 0), (2, None, "a", None, 0, 0), (3, "", None, "en", 0, 0), (4, "été <|endoftext|> 12345", "a", "en", 0, 0),
    (4, "été <|endoftext|> 12345", "a", "en", 0, 0), (5, "word " * 50_000, "b", "de", 0, 0), (6, "no break\x1cx", "b", "de", 0, 0),
]


def encoder():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counts(version, text):
    text = text or ""
    if version == "words-1":
        for c in "\t\n\v\f\r":
            text = text.replace(c, " ")
        return len([w for w in text.split(" ") if w])
    return len(encoder().encode_ordinary(text))


def test_counts(rows):
    got = count_tokens(rows(DOCS, SCHEMA))
    want = [(i, s, lang, v, counts(v, t)) for i, t, s, lang, *_ in DOCS for v in ("words-1", "byte-bpe-50k")]
    assert values(got) == values(rows(want, "a long, b string, c string, d string, e long"))
    assert count_tokens(rows([], SCHEMA)).count() == 0


def test_batches_count_once_and_fold(spark, rows, tmp_path):
    counted = count_tokens(rows(DOCS, SCHEMA), (WORDS,))
    other = count_tokens(rows([(1, "One two", "c", "en", 0, 0)], SCHEMA), (WORDS,))
    totals = Rollup(spark, str(tmp_path))
    assert totals.totals().count() == 0
    assert totals.commit("1", inserts(counted)) and not totals.commit("1", inserts(counted))
    before = values(totals.totals())
    assert totals.commit("2", revisions(counted.where("doc_id = 1"), other))
    assert totals.commit("3", deletes(counted.where("doc_id = 5")))
    want = Counter()
    for i, t, s, lang, *_ in DOCS:
        if i not in (1, 5):
            want[(s, lang, "docs")] += 1
            want[(s, lang)] += counts("words-1", t)
    want[("c", "en", "docs")], want[("c", "en")] = 1, 2
    got = {(r.source, r.lang): (r.docs, r.tokens) for r in Rollup(spark, str(tmp_path)).totals().collect()}
    assert got == {k: (want[(*k, "docs")], want[k]) for k in want if len(k) == 2}
    totals.fold()
    assert not totals.commit("2", revisions(counted.where("doc_id = 1"), other))
    again = Rollup(spark, str(tmp_path))
    assert {(r.source, r.lang): (r.docs, r.tokens) for r in again.totals().collect()} == got
    again.commit("4", revisions(other, counted.where("doc_id = 1")))
    again.commit("5", inserts(counted.where("doc_id = 5")))
    again.fold()
    assert values(again.totals()) == before


def test_a_batch_that_broke_off_is_written_anew(spark, rows, tmp_path):
    counted = count_tokens(rows(DOCS, SCHEMA), (WORDS,))
    inserts(counted).write.parquet(f"{tmp_path}/batches/1")
    (tmp_path / "batches/1/_SUCCESS").unlink()
    totals = Rollup(spark, str(tmp_path))
    assert totals.totals().count() == 0 and totals.commit("1", inserts(counted))
    assert sum(r.docs for r in totals.totals().collect()) == len(DOCS)


def test_the_query_against_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    totals = Rollup(spark, str(tmp_path))
    token_batches(docs, labels, totals, (WORDS, BYTE_PAIRS))
    import regex

    marks = {r.doc_id: r for r in labels.collect()}
    want, encode = Counter(), encoder()
    for r in docs.collect():
        m = marks.get(r.doc_id)
        if m and m.toxic == 1:
            continue
        text = regex.sub(r"[^\p{L}\p{N}\s]+", "", r.text) if m and m.quality == 0 else r.text
        for v in ("words-1", "byte-bpe-50k"):
            want[(r.source, r.lang, v, "docs")] += 1
            want[(r.source, r.lang, v)] += counts(v, text) if v == "words-1" else len(encode.encode_ordinary(text or ""))
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in totals.totals().collect()}
    assert got == {k: (want[(*k, "docs")], want[k]) for k in want if len(k) == 3}
