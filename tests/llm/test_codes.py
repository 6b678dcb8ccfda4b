"""Vector codes against a plain form with Python integers, and the limb products against integer products."""

import math

import numpy as np
import pytest
from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm.codes import compress, exact_product, fit_codebooks, integers, limb_bits

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(vectors, parts=2, entries=3, rounds=2, scale=4096):
    """(codes by row, errors by row, entries by part) with Python integers only; vectors in the order of their ids."""
    width = -(-len(vectors[0]) // parts)
    cut = [[math.floor(scale * x) for x in v] + [0] * (width * parts - len(v)) for v in vectors]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in cut]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        away = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            mine = [nearest(v[p], books[p])[0] for v in cut]
            for e in range(len(books[p])):
                members = [v[p] for v, m in zip(cut, mine, strict=True) if m == e]
                if members:
                    books[p][e] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    return ["".join(f"{e:02x}" for e, _ in f) for f in found], [sum(d for _, d in f) for f in found], books


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 70), st.integers(1, 70), st.randoms(use_true_random=False))
def test_products_are_exact(inner, left_bits, right_bits, rnd):
    def matrix(n, m, bits):
        rows = [[rnd.randint(-(2**bits), 2**bits) for _ in range(m)] for _ in range(n)]
        return np.array(rows, np.int64 if bits < 63 else object).reshape(n, m)

    a, b = matrix(4, inner, left_bits), matrix(inner, 3, right_bits)
    want = a.astype(object) @ b.astype(object)
    got = exact_product(a, b)
    if got.dtype == object:
        assert (got == want).all()
    else:
        assert ((got.astype(object) - want) % 2**64 == 0).all()


def test_limbs_stay_below_the_exact_range():
    for dim in (1, 2, 7, 8, 9, 4096):
        assert dim * 4 ** limb_bits(dim) <= 2**53


def test_integers_are_floors():
    rows = np.array([[-0.1, 0.0, 1 / 4096, -1 / 4096, 0.99, 1e300, -1e300, 2.0**52 + 1]])
    assert integers(rows, 4096).tolist()[0] == [math.floor(4096 * int(x)) if abs(x) > 2**52 else math.floor(4096 * x) for x in rows[0].tolist()]


@pytest.mark.parametrize("size", [1.0, 1e6, 1e30])
def test_against_plain_integers(spark, size):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(40, 5)) * size).tolist()
    vectors[7] = vectors[3]
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(vectors)], SCHEMA).repartition(4)
    books = fit_codebooks(df, parts=2, entries=3, rounds=2)
    codes, errors, entries = plain(vectors)
    assert [list(p) for p in books.entries] == entries
    got = {r.vec_id: r for r in compress(df, books).collect()}
    assert [got[i].code for i in range(40)] == codes
    fits = [e if e < 2**63 else None for e in errors]
    assert [got[i].error for i in range(40)] == fits
    if None not in fits:
        assert all(r.label_error == sum(e for j, e in enumerate(errors) if j % 3 == r.label) for r in got.values())


def test_unusable_vectors_lengths_and_nulls(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (3, [1.0, 2.0], 1), (None, [1.0, 2.0], None), (1, [0.0, 0.0], None), (1, [0.0, 0.0], None), (2, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1),
        (6, [inf, 0.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, [], 2),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<double>, label int, code string, error int")
    books = fit_codebooks(df, parts=2, entries=16, rounds=2)
    assert books.dim == 2 and len(books.entries[0]) == 4
    got = values(compress(df, books), "vec_id", "label", "code", "error", "label_error")
    assert got == [
        (None, None, "0202", 0, 0), (1, None, "0000", 0, 0), (1, None, "0000", 0, 0), (3, 1, "0202", 0, 0), (7, 1, None, None, 0), (8, 2, None, None, None),
    ]


def test_one_vector_is_a_third_of_all_rows(spark):
    df = spark.sql("select id as vec_id, if(id % 3 = 0, array(0.5D, 0.5D), array(id / 900D, 1 - id / 900D)) as embedding, if(id % 3 = 0, null, 1) as label from range(900)")
    books = fit_codebooks(df, parts=2, entries=4, rounds=3)
    vectors = [[0.5, 0.5] if i % 3 == 0 else [i / 900, 1 - i / 900] for i in range(900)]
    codes, errors, _ = plain(vectors, entries=4, rounds=3)
    got = {r.vec_id: (r.code, r.error) for r in compress(df, books).collect()}
    assert [got[i] for i in range(900)] == list(zip(codes, errors, strict=True))


def test_no_vectors(spark):
    for df in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None, 1)], SCHEMA)):
        books = fit_codebooks(df)
        assert books is None
        assert compress(df, books).columns == ["vec_id", "label", "code", "error", "label_error"] and compress(df, books).count() == 0


def test_digest_and_refused_parameters(spark):
    import hashlib

    df = spark.createDataFrame([(1, [0.5, -0.25], 0)], SCHEMA)
    assert fit_codebooks(df, parts=2).digest == hashlib.sha256(b"2048,-1024").hexdigest()
    for wrong in ({"entries": 300}, {"scale": 1000}):
        with pytest.raises(ValueError):
            fit_codebooks(df, **wrong)
