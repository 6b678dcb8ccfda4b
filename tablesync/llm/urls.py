"""Operator 2: block and allow lists over URLs, by Bloom filter cascades without false answers."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.exact import LOWER, UPPER
from tablesync.llm.shared import saved
from tablesync.llm.words import mix

_U = np.uint64
MAX_BYTES = 64 << 20
MAX_LEVELS = 64


@dataclass
class Level:
    bits: np.ndarray  # 64-bit words
    hashes: int


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, size: int, hashes: int) -> Iterator[np.ndarray]:
    """The bits of each key at a level: every level deals the two key hashes anew."""
    a, b = mix(h1 + _U(2 * level + 1)), mix(h2 ^ _U(0x5851F42D4C957F2D * (level + 1) & (1 << 64) - 1)) | _U(1)
    for k in range(hashes):
        yield (a + _U(k) * b) % _U(size)


def _passes(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    found = np.ones(len(h1), bool)
    for p in _positions(h1, h2, number, len(level.bits) * 64, level.hashes):
        found &= (level.bits[p >> _U(6)] >> (p & _U(63))) & _U(1) == 1
    return found


def member(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed: the first level a key fails decides, odd levels hold listed keys."""
    listed, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
    for number, level in enumerate(levels):
        # passing the last level says what that level encodes
        open_ = open_[_passes(level, number, h1[open_], h2[open_])]
        listed[open_] = number % 2 == 0
        if not len(open_):
            break
    return listed


def _u64(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


def _filled(keys: DataFrame, number: int, size: int, hashes: int) -> Level:
    """One level's bits, set by tasks and combined word by word; the driver gets at most ``size`` bits."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _u64(batch.column("h1")), _u64(batch.column("h2"))
            p = np.unique(np.concatenate(list(_positions(h1, h2, number, size, hashes))))
            word, first = np.unique(p >> _U(6), return_index=True)
            bits = np.bitwise_or.reduceat(_U(1) << (p & _U(63)), first) if len(p) else p
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    rows = keys.select("h1", "h2").mapInArrow(put, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out, found = np.zeros(size // 64, np.int64), rows.toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Level(out.view(_U), hashes)


def build_cascade(listed: DataFrame, universe: DataFrame, rate: float = 1 / 64, max_bytes: int = MAX_BYTES) -> list[Level]:
    """Levels that tell exactly which keys of ``universe`` are in ``listed`` (both: one string column ``key``).

    The first level encodes the listed keys, the second the unlisted keys of the universe that pass the first, the third
    the listed keys that pass the second, and so on until no key of the universe is judged wrongly. Sizes come from
    counts; a cascade beyond ``max_bytes`` is refused with an error, as its bits go to every task. The universe is read
    once, later levels see only what passed.
    """
    spark = listed.sparkSession
    hashes_of = key_hashes(F.col("key"))
    mine = saved(listed.where("key is not null").select("key").distinct().select("key", *hashes_of), "listed")
    others = universe.where("key is not null").select("key", *hashes_of)
    levels: list[Level] = []
    wrong, against = mine, None
    while (n := wrong.count()) > 0:
        if len(levels) == MAX_LEVELS:
            raise ValueError("two different keys have the same hashes, so no cascade can part them")
        hashes = max(1, round(-math.log2(rate)))
        size = 64 * math.ceil(max(64, n * hashes / math.log(2)) / 64)
        if size // 8 + sum(level.bits.nbytes for level in levels) > max_bytes:
            raise ValueError(f"the cascade of {n} keys needs more than {max_bytes} bytes; raise max_bytes or split the list")
        number = len(levels)
        levels.append(_filled(wrong, number, size, hashes))
        shared = spark.sparkContext.broadcast(levels[-1])

        def passing(batches, shared=shared, number=number):
            for batch in batches:
                found = _passes(shared.value, number, _u64(batch.column("h1")), _u64(batch.column("h2")))
                yield batch.filter(pa.array(found))

        # listed keys pass the first level as well: they are told apart once, by the few keys that pass
        pool = others if against is None else against
        passed = pool.mapInArrow(passing, "key string, h1 long, h2 long")
        if against is None:
            passed = passed.join(mine.select("key"), "key", "left_anti")
        wrong, against = saved(passed.distinct(), "passed"), wrong
    return levels


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up
    to ``?``, ``#`` or the end. Both are empty without ``://`` or for a null."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every key that a rule fitting this URL could have: host suffixes of up to ``labels`` labels with path prefixes of
    the ``lengths`` that occur in rules. One expression for any number of either."""
    if not labels or not lengths:
        return F.array().cast("array<string>")
    held = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    asked = F.filter(F.split(F.lit(",".join(map(str, lengths))), ",").cast("array<int>"), lambda m: m <= F.length(path))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(held, F.lit(labels))), lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(asked, lambda m: F.concat(s, F.substring(path, F.lit(1), m)))))
    return F.when(F.length(host) > 0, keys).otherwise(F.array().cast("array<string>"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", unlisted: str = "allow", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (block or allow). A rule fits its host and all subdomains when the URL's path
    starts with the rule's; the longest fitting rule (host and path together, then host) decides, and ``rule`` is its host and path; of
    equal rules with both verdicts, block wins. Without a fitting rule ``rule`` is null and the verdict ``unlisted``.
    Each list becomes a cascade over all keys that the pages' URLs can be asked for, so the two cascades answer exactly,
    and judging is a scan with no join. A null URL, or one without ``://``, has an empty host and path and fits nothing.
    Repeated pages are judged row by row; no pages, no rows; no rules, all ``unlisted``. Rules with a null are ignored.
    """
    spark = pages.sparkSession
    rules = rules.where("host is not null and path is not null").select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    labels = rules.select(F.max(F.size(F.split("host", r"\."))).alias("n")).first().n or 0
    lengths = sorted(r.n for r in rules.select(F.length("path").alias("n")).distinct().collect())  # at most the longest path
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    asked = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))

    listed = rules.select(F.concat("host", "path").alias("key"), "verdict")
    universe = saved(asked.select(F.explode("keys").alias("key")).distinct(), "universe")
    cascades = [build_cascade(listed.where(F.col("verdict") == v).select("key"), universe, max_bytes=max_bytes) for v in ("block", "allow")]
    shared = spark.sparkContext.broadcast(cascades)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column("h1"), batch.column("h2")
            flat = _u64(h1.flatten()), _u64(h2.flatten())
            lists = [pa.ListArray.from_arrays(_offsets(h1), pa.array(member(c, *flat))) for c in shared.value]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "keys")), *lists], names=_NAMES)

    hashed = asked.select(
        "page_id", "host", "path", "keys",
        F.transform("keys", lambda k: F.xxhash64(k)).alias("h1"), F.transform("keys", lambda k: F.xxhash64(k, F.lit(1))).alias("h2"),
    )
    id_type = hashed.schema["page_id"].dataType.simpleString()
    found = hashed.mapInArrow(look_up, f"page_id {id_type}, host string, path string, keys array<string>, block array<boolean>, allow array<boolean>")
    fits = F.filter(F.arrays_zip("keys", "block", "allow"), lambda x: x["block"] | x["allow"])
    host_chars = lambda k: F.length(k) - F.length(F.regexp_extract(k, r"^[^/]*(.*)", 1))
    best = F.array_max(
        F.transform(
            fits, lambda x: F.struct(F.length(x["keys"]).alias("n"), host_chars(x["keys"]).alias("h"), x["keys"].alias("rule"), x["block"].alias("block"))
        )
    )
    found = found.withColumn("best", best)
    verdict = F.when(F.col("best").isNull(), F.lit(unlisted)).when(F.col("best.block"), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


_NAMES = ["page_id", "host", "path", "keys", "block", "allow"]


def _offsets(lists) -> pa.Array:
    """Offsets of a list column that start at 0."""
    off = lists.offsets.to_numpy()
    return pa.array((off - off[0]).astype(np.int32))
