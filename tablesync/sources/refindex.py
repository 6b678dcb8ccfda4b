"""A maintained index of references: target → the owners that mention it, kept up to date by what an apply changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.placement import complete_tables, delete_path
from tablesync.operators.refs import link_postings, sweep_postings

POSTING = ["col", "kind", "target_id", "anchor_id", "ref"]


class ReferenceIndex:
    """Signed postings in a shared folder: +n for references that came, -n for those that went.

    What an apply changed or deleted is read as it was and as it is; all other texts are never read again. A batch counts once its table is
    complete, and a number that is complete is not written again, so a repeated update changes nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], cols: list[str]):
        self.spark, self.root, self.keys, self.cols = spark, root.rstrip("/"), list(keys), list(cols)

    def _tables(self) -> list[str]:
        """The last fold and the batches after it."""
        folds = complete_tables(self.spark, f"{self.root}/folds")
        last = folds[-1] if folds else ""
        later = [b for b in complete_tables(self.spark, f"{self.root}/postings") if b > last]
        return [f"{self.root}/folds/{last}"] * bool(folds) + [f"{self.root}/postings/{b}" for b in later]

    def _signed(self, df: DataFrame, sign: int) -> DataFrame:
        return link_postings(df, self.keys, self.cols).withColumn("n", F.lit(sign).cast("long"))

    def update(self, batch: int, before: DataFrame | None, after: DataFrame | None) -> bool:
        """Add batch ``batch``: the changed and deleted owners as they were, the changed and new ones as they are. False if it is there already."""
        name, known = f"{batch:08d}", self._tables()
        if any(t.endswith(name) for t in known) or (known and "/folds/" in known[0] and name < known[0][-8:]):
            return False
        parts = [self._signed(df, sign) for df, sign in ((before, -1), (after, 1)) if df is not None]
        postings = reduce(DataFrame.unionByName, parts).groupBy(*self.keys, *POSTING).agg(F.sum("n").alias("n")).where("n <> 0")
        postings.write.mode("overwrite").parquet(f"{self.root}/postings/{name}")
        return True

    def references(self) -> DataFrame:
        """The references there are now: keys, col, kind, target_id, anchor_id, ref, and ``n``, how often."""
        rows = self.spark.read.parquet(*self._tables())
        return rows.groupBy(*self.keys, *POSTING).agg(F.sum("n").alias("n")).where("n <> 0")

    def owners(self, targets: DataFrame, kind: str = "link") -> DataFrame:
        """Who mentions the pages ``targets(id)``: keys, col, target_id, ref, n."""
        asked = targets.select(F.col("id").cast("int").alias("target_id")).distinct()
        return self.references().where(F.col("kind") == kind).join(asked, "target_id", "left_semi").select(*self.keys, "col", "target_id", "ref", "n")

    def sweep(self, pages: DataFrame, page_id: str, paras: DataFrame, para_id: str) -> tuple[DataFrame, DataFrame]:
        """What ``link_sweep`` gives for the rows as they are now, without reading a text."""
        unresolved, resolved = sweep_postings(self.references(), pages, page_id, paras, para_id)
        return unresolved.select(*self.keys, "col", "kind", "missing_id", "ref"), resolved

    def fold(self) -> None:
        """Put all batches into one table, which counts instead of them once it is complete; then they are deleted."""
        known = self._tables()
        if len(known) > 1:
            self.references().write.mode("overwrite").parquet(f"{self.root}/folds/{known[-1][-8:]}")
            for table in known:
                if "/postings/" in table or not table.endswith(known[-1][-8:]):
                    delete_path(self.spark, table)
