"""Text sources: one file per row, and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.placement import cut, ordinal
from tablesync.operators.schema import coerce

# The lines around the JSON summary at the head of a run log.
SUMMARY_START = r"=== (?!END )[A-Z]+ SUMMARY ==="
SUMMARY_END = "=== END SUMMARY ==="

SUMMARY = (
    "operation string, timestamp string, dryRun boolean, totalCreated int, totalUpdated int, "
    "totalSkipped int, totalFailed int, errors array<string>, advice array<string>, "
    "predicates array<struct<name string, table string, created int, updated int, skipped int, failed int>>"
)


# A top-level entry of a row file: its key, and its value with the indented lines that belong to it.
ENTRY = r'(?m)^"?([^"\n:#]+?)"?[ ]*:[ ]*(.*(?:\n(?:[ \t]+.*|(?=\n)))*)$'


def _value(raw: Column) -> Column:
    """A scalar as text; NULL for nothing, ``~`` and ``null``. Blocks lose their indentation, quotes their escapes."""
    block = F.regexp_replace(F.regexp_replace(raw, r"^\|[-+]?[ ]*\n", ""), r"(?m)^  ", "")
    double = F.regexp_replace(F.regexp_extract(raw, r'(?s)^"(.*)"[ ]*$', 1), r'\\(["\\])', "$1")
    single = F.replace(F.regexp_extract(raw, r"(?s)^'(.*)'[ ]*$", 1), F.lit("''"), F.lit("'"))
    plain = F.trim(raw)
    return (
        F.when(raw.rlike(r"^\|[-+]?[ ]*(\n|$)"), F.regexp_replace(block, r"\n+$", ""))
        .when(raw.rlike(r'(?s)^".*"[ ]*$'), double)
        .when(raw.rlike(r"(?s)^'.*'[ ]*$"), single)
        .when(~plain.isin("", "~", "null"), plain)
    )


def _in_few_tasks(files: DataFrame) -> DataFrame:
    """Rows of very many small files by a number of tasks that goes by the cluster: Spark opens about 32 such files a task."""
    return files.coalesce(8 * files.sparkSession.sparkContext.defaultParallelism)


def read_row_files(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.yml"
) -> tuple[DataFrame, DataFrame]:
    """Rows of a folder with one file each, typed by ``schema``; adds ``_path``. Returns (rows, rejects).

    A file is a flat list of ``key: value`` lines: plain, quoted, or a block behind ``|``. Nested values are
    rejected, as are cells that do not parse. ``_meta`` files are skipped, column names match without case, and ``_path``
    gives the order that merges need.
    """
    files = (
        spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("_path"), "value", F.col("_metadata.file_name").alias("_file"))
        .where(F.lower("_file") != "_meta.yml")
    )
    files = _in_few_tasks(files)
    body = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "\r\n", "\n")
    entries = F.zip_with(
        F.regexp_extract_all(body, F.lit(ENTRY), F.lit(1)), F.regexp_extract_all(body, F.lit(ENTRY), F.lit(2)),
        lambda k, v: F.struct(F.lower(F.trim(k)).alias("key"), v.alias("raw")),
    )
    cells = files.select("_path", entries.alias("_entries"))
    names = [f.name.lower() for f in schema.fields]

    def raw(name: str) -> Column:
        return F.try_element_at(F.filter("_entries", lambda e: e["key"] == name), F.lit(-1))["raw"]

    nested = F.filter("_entries", lambda e: e["key"].isin(*names) & e["raw"].rlike(r"^\s*(\n[ \t]*\S|[\[{])"))
    flat = lambda name: F.when(~raw(name).rlike(r"^\s*(\n[ \t]*\S|[\[{])"), _value(raw(name)))
    text = cells.select("_path", *[flat(f.name.lower()).alias(f.name) for f in schema.fields])
    rows, rejects = coerce(text, schema, ["_path"])
    odd = cells.select("_path", F.inline(nested)).select("_path", F.col("key").alias("col"), F.col("raw").alias("value"))
    return rows, rejects.unionByName(odd)


def _log_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """All lines of all logs with their place: the offset of the part of the file that a task read, and a number in it."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("written_at"),
        F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("n")).alias("place"),
        F.col("value").alias("line"),
    )
    lines = cut(_in_few_tasks(lines))
    start, end = F.col("line").rlike(f"^{SUMMARY_START}\\s*$"), F.col("line").rlike(f"^{SUMMARY_END}\\s*$")
    marks = lines.where(start | end).groupBy("file_name").agg(F.min(F.when(start, F.col("place"))).alias("first"), F.min(F.when(end, F.col("place"))).alias("last"))
    marks = marks.where("first < last").withColumnRenamed("file_name", "_file")
    return lines.join(marks, F.col("file_name") == F.col("_file"), "left").drop("_file")


def read_run_logs(spark: SparkSession, folder: str, pattern: str = "*.log") -> DataFrame:
    """One row per log, newest first: file_name, written_at and the parsed summary (NULL if there is none).

    Logs are read as lines; only the lines of the summary at the head of a log are put together. An empty log has no row.
    """
    lines = _log_lines(spark, folder, pattern)
    inside = (F.col("place") > F.col("first")) & (F.col("place") < F.col("last"))
    block = F.sort_array(F.collect_list(F.when(inside, F.struct("place", "line"))))  # the summary's lines alone
    logs = lines.groupBy("file_name", "written_at").agg(F.array_join(F.transform(block, lambda x: x["line"]), "\n").alias("block"))
    summary = F.when(F.col("block") != "", F.from_json("block", SUMMARY)).alias("summary")
    return logs.select("file_name", "written_at", summary).orderBy(F.desc("written_at"), F.desc("file_name"))


def read_log_lines(spark: SparkSession, folder: str, pattern: str = "*.log") -> DataFrame:
    """The lines behind the summary of each log, or all lines of a log without one: file_name, line_no, line."""
    lines = _log_lines(spark, folder, pattern).where("last is null or place > last")
    return ordinal(lines.select("file_name", "place", "line"), ["file_name"], ["place"], "line_no").select("file_name", "line_no", "line")
