"""One key holds a third of all rows: joins split it, aggregates meet it pre-reduced, results stay whole."""

import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import identity, integrity, merge, placement, quality, refs, tree
from tablesync.spec import TableSpec

N = 30_000


@pytest.fixture
def tight(spark):
    """Thresholds that make a few hundred kilobytes a skewed partition, and no broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=N):
    """Ids with one value in a third of the rows, spread over several input partitions."""
    rows = spark.range(0, n, 1, 8).withColumn("pad", F.md5(F.col("id").cast("string")))
    return rows.withColumn("ref", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000 + 100))


def dim(spark, step=1):
    return spark.range(0, 6000, step, 8).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("guid"))


def test_orphan_lookup_splits_the_hot_parent(tight):
    # The hot parent is missing, so every one of its rows must come out.
    df = integrity.fk_orphans(hot(tight), dim(tight).where("k <> 7"), "ref", "k")
    assert re.search(r"skew=true|isSkewJoin=true", final_plan(df)) and df.count() == N // 3


def test_guid_lookup_splits_the_hot_id(tight):
    df, warnings = identity.resolve_guid(hot(tight), "ref", dim(tight).where("k <> 7"), "k", "guid", "guid")
    assert re.search(r"skew=true|isSkewJoin=true", final_plan(df)) and df.where("guid is null").count() == N // 3
    assert values(warnings, "id", "rows") == [(7, N // 3)]


def test_rewriting_splits_the_hot_page(tight):
    texts = hot(tight).select("id", F.concat(F.lit("Default.aspx?ID="), F.col("ref").cast("string"), F.lit(" "), "pad").alias("t"))
    pages = tight.range(0, 6000).select(F.col("id").cast("int").alias("source_id"), (F.col("id") + 10000).cast("int").alias("target_id"))
    df = refs.rewrite_links(texts, ["id"], ["t"], pages, pages.where("false"))
    assert re.search(r"skew=true|isSkewJoin=true", final_plan(df))
    assert df.where("t like 'Default.aspx?ID=10007 %'").count() == N // 3 and df.count() == N


def test_sweep_meets_the_hot_page_once(tight):
    texts = hot(tight).select("id", F.concat(F.lit("Default.aspx?ID="), F.col("ref").cast("string")).alias("t"))
    pages = tight.range(0, 6000).where("id <> 7")
    unresolved, resolved = refs.link_sweep(texts, ["id"], ["t"], pages, "id", pages, "id")
    assert unresolved.count() == N // 3 and resolved.first()["resolved"] == N - N // 3


def test_tree_under_one_parent(tight):
    nodes = hot(tight, 6000).select(
        F.when(F.col("id") == 0, 7).otherwise(F.col("id") + 10000).alias("id"),
        F.when(F.col("id") == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") - F.col("id") % 3 + 10000).alias("parent"),
        F.lit("n").alias("name"),
    )
    got = tree.build_paths(nodes, "id", "parent", "name")
    # The two nodes below the renamed root 10000 hang from nothing.
    assert dict(values(got.groupBy("depth").count())) == {1: 1, 2: 1999, 3: 3998}


def test_last_of_a_hot_key_is_reduced_before_the_shuffle(tight):
    df = merge.dedupe_incoming(hot(tight).select("ref", "id", "pad"), ["ref"], "id")
    assert "WindowGroupLimit" in final_plan(df)
    assert df.where("ref = 7").first()["id"] == (N - 1) // 3 * 3


def test_users_of_a_hot_asset_stay_rows(tight):
    used = hot(tight).select(F.concat(F.lit("a"), F.col("ref").cast("string")).alias("path"), F.col("id").cast("string").alias("u"))
    assets = quality.asset_refs([(used, "item-type", "path", "u")])
    users = quality.users_per_asset(assets)
    assert users.where("path = 'a7'").first()["n_users"] == N // 3 and assets.count() == N
    missing = quality.missing_assets(assets, assets.select("kind", "path").limit(0))
    assert missing.count() == N


def test_numbering_a_hot_group_uses_many_tasks(tight):
    df = hot(tight).select("ref", "id")
    got = placement.ordinal(df, ["ref"], ["id"], "n")
    seven = got.where("ref = 7")
    assert seven.agg(F.count_distinct("n").alias("d"), F.max("n").alias("m")).first() == (N // 3, N // 3)
    assert seven.where("n <> id / 3 + 1").count() == 0 and got.count() == N


def test_upsert_with_many_null_keys_keeps_one_row(tight):
    incoming = hot(tight).select(F.when(F.col("ref") != 7, F.col("id")).alias("k"), "pad", "id")
    from tablesync.plans.apply import apply_snapshot
    from tablesync.spec import SyncSpec

    target = tight.range(0, 10).select(F.col("id").alias("k"), F.lit("old").alias("pad"))
    got = apply_snapshot(target, incoming, SyncSpec(TableSpec("t", ("k",))), order="id").table
    assert got.groupBy("k").count().where("count > 1").count() == 0
    assert got.where("k = 0").first()["pad"] != "old"
