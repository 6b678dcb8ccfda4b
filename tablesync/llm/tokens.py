"""Operator 7: token totals by source, language and tokenizer version, kept up to date by signed batches."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.words import text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY_BYTES = 64 << 20
# Fixed value: how the byte-level vocabulary cuts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

KEYS = ["source", "lang", "tokenizer"]


@dataclass(frozen=True)
class Tokenizer:
    """A named version: a file of byte-pair ranks and its pattern, or, without a file, words between ASCII blanks."""

    version: str
    path: str | None = None
    pattern: str = PATTERN


WORDS = Tokenizer("words-1")
BYTE_PAIRS = Tokenizer("byte-bpe-50k", VOCABULARY)


@functools.lru_cache(8)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding(hashlib.sha256(ranks).hexdigest(), pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _words(column) -> list[int]:
    data, off = text_bytes(column)
    word = ~np.isin(data, (9, 10, 11, 12, 13, 32))
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    opens[off[:-1][off[:-1] < len(data)]] = word[off[:-1][off[:-1] < len(data)]]
    sums = np.concatenate([[0], np.cumsum(opens)])
    return (sums[off[1:]] - sums[off[:-1]]).tolist()


def count_tokens(
    docs: DataFrame,
    tokenizers: tuple[Tokenizer, ...] = (WORDS, BYTE_PAIRS),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per document and tokenizer: doc_id, source, lang, tokenizer, tokens, from whole texts.

    Vocabulary files are read by the driver, at most ``MAX_VOCABULARY_BYTES`` each, and sent to the tasks. Special tokens
    in a text are ordinary text. A null or empty text has 0 tokens.
    """
    sent = []
    for t in tokenizers:
        ranks = None
        if t.path:
            with open(t.path, "rb") as f:
                ranks = f.read(MAX_VOCABULARY_BYTES + 1)
            if len(ranks) > MAX_VOCABULARY_BYTES:
                raise ValueError(f"{t.path} is larger than {MAX_VOCABULARY_BYTES} bytes")
        sent.append((t.version, ranks, t.pattern))
    shared = docs.sparkSession.sparkContext.broadcast(sent)
    slim = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang")).alias("row"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for version, ranks, pattern in shared.value:
                if ranks is None:
                    n = _words(batch.column(1))
                else:
                    encoding = _encoding(ranks, pattern)
                    n = [len(encoding.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in batch.column(1)]
                names = pa.array([version] * len(n), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(n, pa.int64())], names=["row", "tokenizer", "tokens"])

    row = slim.schema["row"].dataType.simpleString()
    return slim.mapInArrow(count, f"row {row}, tokenizer string, tokens long").select("row.*", "tokenizer", "tokens")


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).alias("docs"), "tokens")


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Documents whose text, source, language or count changed: the old counts out, the new ones in."""
    return deletes(before).unionByName(inserts(after))


class Rollup:
    """Totals by ``KEYS`` as the sum of committed batches in a shared folder.

    A batch is a few rows, its signed changes summed by key. It counts once its table is complete, and a batch id that is
    complete is never written again: a retry or a replay of a batch changes nothing, and a batch that broke off
    is written anew. One writer at a time; readers see whole batches only. ``fold`` replaces batches by their sum
    and remembers their ids.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _whole(self, kind: str) -> list[str]:
        """Names of the complete tables of a kind, in order."""
        at = self._path(f"{self.root}/{kind}")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(n for n in names if self._fs.exists(self._path(f"{self.root}/{kind}/{n}/_SUCCESS")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows (``KEYS``, docs, tokens); False if this id had been committed before."""
        if not batch or any(c in batch for c in "/\\:"):
            raise ValueError(f"not a batch id: {batch!r}")
        if batch in self._whole("batches") or batch in self._folded():
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        summed.write.mode("overwrite").parquet(f"{self.root}/batches/{batch}")
        return True

    def _sums(self) -> tuple[str | None, str | None]:
        folds = self._whole("ids")
        return (f"{self.root}/folds/{folds[-1]}", f"{self.root}/ids/{folds[-1]}") if folds else (None, None)

    def _folded(self) -> set[str]:
        ids = self._sums()[1]
        return {r.batch for r in self.spark.read.parquet(ids).collect()} if ids else set()  # one short row per batch

    def totals(self) -> DataFrame:
        """One row per source, language and tokenizer version with documents or tokens left: also docs and tokens."""
        folded = self._folded()
        open_ = [f"{self.root}/batches/{b}" for b in self._whole("batches") if b not in folded]
        tables = [t for t in (self._sums()[0], *open_) if t]
        schema = "source string, lang string, tokenizer string, docs long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*tables) if tables else self.spark.createDataFrame([], schema)
        summed = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 or tokens <> 0")

    def fold(self) -> None:
        """Replace the open batches by one table; it counts once the list of the ids in it is complete."""
        ids = sorted(self._folded() | set(self._whole("batches")))
        name = f"{len(self._whole('ids')):08d}"
        self.totals().write.mode("overwrite").parquet(f"{self.root}/folds/{name}")
        self.spark.createDataFrame([(i,) for i in ids], "batch string").write.mode("overwrite").parquet(f"{self.root}/ids/{name}")
        for batch in ids:
            self._fs.delete(self._path(f"{self.root}/batches/{batch}"), True)
