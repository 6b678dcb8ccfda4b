import hashlib
import random

import pytest
from test_words import split

from tablesync.llm.decontaminate import contamination, keep_clean

SCHEMA = "doc_id long, text string, row string, items int"


def brute(docs, items, size=10):
    windows = {}
    for i, text in items:
        w = split(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(i) if i is not None else "null")
    lengths = {len(k) for k in windows}
    out = []
    for i, text, *_ in docs:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        ids = sorted(found)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def judged(df):
    return sorted((tuple(r) for r in df.drop("items").collect()), key=str)


def data(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "a", "to", *"qrstuvwxyz", "Éa", "7b"])
    items = [(k, " ".join(word() for _ in range(rng.choice((1, 2, 5, 9, 10, 11, 14, 30))))) for k in range(40)]
    items += [(3, items[5][1]), (None, "null item words"), (90, ""), (91, None), (92, "..."), (93, items[7][1])]
    docs = []
    for k in range(150):
        w = [word() for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(items)[1] or "")
        docs.append((k, rng.choice((" ", " - ", "\n")).join(w), "r", 1))
    docs += [(500, None, "r", 1), (501, "", "r", 1), (7, docs[7][1], "r", 1), (None, items[3][1].upper(), "r", 1)]
    docs += [(502, "the of " * 50_000 + items[12][1], "r", 1)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [16 << 20, 200, 1])
def test_against_all_windows(rows, block_bytes):
    docs, items = data()
    got = contamination(rows(docs, SCHEMA), rows(items, "item_id int, text string"), block_bytes=block_bytes)
    assert judged(got) == brute(docs, items)


def test_other_window_sizes(rows):
    docs, items = data(4)
    got = contamination(rows(docs, SCHEMA), rows(items, "item_id int, text string"), size=3)
    assert judged(got) == brute(docs, items, 3)


def test_nothing_to_compare(rows):
    docs = [(1, "a b", "r", 1), (None, None, "r", 1)]
    for items in ([], [(1, None), (2, "")]):
        got = contamination(rows(docs, SCHEMA), rows(items, "item_id int, text string"))
        assert judged(got) == brute(docs, [])
    assert contamination(rows([], SCHEMA), rows([(1, "a")], "item_id int, text string")).count() == 0


def test_clean_documents_stay_whole(rows):
    docs, items = data(2)
    got = keep_clean(rows(docs, SCHEMA), rows(items, "item_id int, text string"))
    assert got.columns == ["doc_id", "text", "row", "items"]
    clean = [x[0] for x in brute(docs, items) if not x[5]]
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(clean, key=str)
