"""Chains of snapshots against versions kept whole."""

import random

import pytest
from conftest import values

from tablesync.sources.chain import SnapshotChain
from tablesync.spec import TableSpec

SCHEMA = "k int, s string, v string"
SPEC = TableSpec("t", ("k", "s"))


def frame(spark, rows):
    return spark.createDataFrame(sorted((k, s, v) for (k, s), v in rows.items()), SCHEMA)


def test_every_version_stays_readable(spark, tmp_path):
    r = random.Random(3)
    rows = {(k, f"S{k % 2}"): f"v{k}" for k in range(30)}
    chain, kept = SnapshotChain.create(frame(spark, rows), f"{tmp_path}/c", SPEC), [dict(rows)]
    for step in range(5):
        for k in r.sample(sorted(rows), 4):
            del rows[k]
        for k in r.sample(range(60), 5):
            rows[k, f"S{k % 2}"] = f"new{step}-{k}"
        assert chain.snapshot(frame(spark, rows)) == step + 1
        kept.append(dict(rows))
        if step == 2:
            assert chain.compact() == 3
    assert chain.versions() == list(range(6))
    for n, want in enumerate(kept):
        assert values(chain.read(n)) == values(frame(spark, want))
    deltas = spark.read.parquet(f"{chain.root}/delta/00000005")
    assert deltas.count() <= 9  # what changed, not the table
    chain.expire(4)
    assert chain.versions() == [3, 4, 5] and values(chain.read()) == values(frame(spark, kept[-1]))
    with pytest.raises(ValueError):
        chain.read(1)


def test_changes_and_markers(spark, tmp_path):
    chain = SnapshotChain.create(frame(spark, {(1, "a"): "x", (2, "b"): "y"}), f"{tmp_path}/c", SPEC)
    # a key that is both changed and gone is changed; keys match without case; unknown ones do no harm
    chain.append(frame(spark, {(1, "A"): "z"}), spark.createDataFrame([(1, "a"), (2, "B "), (9, "q")], "k long, s string"))
    assert values(chain.read()) == [(1, "A", "z")] and values(chain.read(0)) == [(1, "a", "x"), (2, "b", "y")]
    assert chain.append(frame(spark, {(5, "e"): "new"}).limit(0)) == 2 and values(chain.read()) == [(1, "A", "z")]


def test_broken_off_deltas_are_not_read(spark, tmp_path):
    chain = SnapshotChain.create(frame(spark, {(1, "a"): "x"}), f"{tmp_path}/c", SPEC)
    chain.append(frame(spark, {(1, "a"): "broken"}))
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{chain.root}/delta/00000001/_SUCCESS")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, False)
    assert chain.versions() == [0] and values(chain.read()) == [(1, "a", "x")]
    assert chain.append(frame(spark, {(1, "a"): "whole"})) == 1 and values(chain.read()) == [(1, "a", "whole")]
