"""A maintained reference index against full sweeps."""

import random

from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import refs
from tablesync.sources.refindex import ReferenceIndex

SCHEMA = "id int, a string, b string"


def text(r):
    return " ".join(r.choice([f"Default.aspx?ID={r.randrange(12)}", f"default.aspx?id={r.randrange(12)}#{r.randrange(5)}", f'{{"SelectedValue":"{r.randrange(12)}"}}', "x"]) for _ in range(4))


def test_sweeps_after_three_applies_equal_full_ones(spark, tmp_path):
    r = random.Random(8)
    rows = {i: (text(r), text(r) if i % 3 else None) for i in range(60)}
    frame = lambda part: spark.createDataFrame([(i, *v) for i, v in sorted(part.items())], SCHEMA)
    pages = spark.createDataFrame([(i,) for i in range(7)], "p int")
    paras = spark.createDataFrame([(i,) for i in range(3)], "q int")
    index = ReferenceIndex(spark, f"{tmp_path}/i", ["id"], ["a", "b"])
    assert index.update(0, None, frame(rows))
    for step in range(1, 4):
        touched = r.sample(sorted(rows), 6)
        before = {i: rows[i] for i in touched}
        for i in touched[:2]:
            del rows[i]
        for i in touched[2:]:
            rows[i] = (text(r), text(r))
        rows[100 + step] = (text(r), "")
        after = {i: rows[i] for i in (*touched[2:], 100 + step)}
        assert index.update(step, frame(before), frame(after)) and not index.update(step, frame(before), frame(after))
        want, fine = refs.link_sweep(frame(rows), ["id"], ["a", "b"], pages, "p", paras, "q")
        got, resolved = index.sweep(pages, "p", paras, "q")
        assert values(got) == values(want) and resolved.first()[0] == fine.first()[0]
        if step == 2:
            index.fold()
            assert len(index._tables()) == 1 and not index.update(1, None, frame(rows))
    owners = index.owners(pages.select(F.col("p").alias("id")).where("id = 3"))
    mentions = refs.extract_links(frame(rows), ["id"], ["a", "b"]).where("kind = 'link' and target_id = 3")
    assert owners.agg(F.sum("n")).first()[0] == mentions.count()
