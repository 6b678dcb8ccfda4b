"""Tables in the shared folder, and texts inside of row structs."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.placement import delete_path, work_path


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back: the lineage ends on storage that outlives
    executors, and later steps that use the frame twice read it instead of computing it twice."""
    path = work_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the table behind a frame of ``saved`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def whole_rows(docs: DataFrame) -> list[Column]:
    """All columns, to be held in one struct, where no name can clash."""
    return [F.col(f"`{c}`") for c in docs.columns]


def texts_of(batch, text_col: str):
    """The texts of a batch whose first column is a struct: a column of their own, or a field of the struct."""
    return batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column(0), [text_col])
