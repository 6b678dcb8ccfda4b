"""Operator 12: how the words of sources differ inside each language, exact in integers.

One CountVectorizer fits the vocabularies of all languages: every term carries its language, so each language's terms are kept by its
own documents alone. The sparse document vectors over its vocabulary are built in numpy and summed by source and term. Pairs of sources are then evaluated from
the sums that are not zero: term by term, only the sources in which a term occurs are compared with the others of the
language; all other terms of a pair share one value, which is multiplied.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.shared import forget, saved
from tablesync.llm.words import LOWER, Words, mix, text_bytes, word_blocks

MAX_VOCABULARY = 2**31 - 1
SLICE_TERMS = 1_000_000  # kept terms for one vectorizer, whose vocabulary is held by the driver and sent to the tasks
SAMPLE = 256  # one term in so many is counted to find out how many are kept
FOLD = 4 << 20  # bytes of texts whose terms are folded at once
SUMMED = 1 << 20  # bytes of texts whose vectors are made at once
HELD = 1 << 19  # sums of sources and terms that a task holds before it hands them out
DOCS_PER_PART, MOST_PARTS = 5_000, 100_000  # tasks of the fit, each with all occurrences of its terms
ROWS_PER_PIECE = 250_000  # counted terms of a language in one task of the evaluation
CELLS = 1 << 20  # of one block of the evaluation
SOURCES = 512  # in one block of a pair table
TABLES = 64  # blocks of pair tables held by a task
LETTERS = np.zeros(256, dtype=bool)
LETTERS[97:123] = LETTERS[128:] = True
_NOTHING = " "  # never a term: keeps a vocabulary from being empty
_PAIR, _TERM = 0, 1


def _groups(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source and text, nulls being ''."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def _tagged(block: Words, pick: np.ndarray, tags: list[bytes]) -> pa.Array:
    """The picked terms of a block, lower-cased, each behind its text's tag, as one list per text; no loop over terms."""
    starts, ends = block.starts[pick], block.ends[pick]
    text = np.searchsorted(block.offsets, np.flatnonzero(pick), "right") - 1
    lengths, front = ends - starts, np.array([len(t) for t in tags], np.int64)[text]
    offsets = np.concatenate([[0], np.cumsum(lengths + front)])
    out = np.empty(offsets[-1], np.uint8)
    behind = offsets[:-1] + front
    # the letters of all terms are copied at once: each byte's place is its number plus the shift of its term
    letters = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    out[letters + np.repeat(behind - starts, lengths)] = LOWER[block.data[letters]]
    for tag in set(tags):
        mine = np.flatnonzero(np.array([t == tag for t in tags])[text])
        for k, byte in enumerate(tag):
            out[offsets[mine] + k] = byte
    terms = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))
    held = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(tags)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(held, pa.int32()), terms)


def _term_keys(block: Words, tags: list[bytes]) -> np.ndarray:
    """A hash of each term of a block with its language, to deal terms into slices."""
    seeds = np.array([zlib.crc32(t) for t in tags], np.uint64)
    return mix(block.hashes ^ mix(np.repeat(seeds, np.diff(block.offsets))))


def _long_blocks(column, size_of: int) -> Iterator[Words]:
    """Blocks of the words of whole texts, put together to about ``size_of`` bytes so that equal terms meet."""

    def merged(found: list[Words]) -> Words:
        shifts = np.cumsum([0, *(len(b.hashes) for b in found)])
        offsets = [np.zeros(1, np.int64), *(b.offsets[1:] + s for b, s in zip(found, shifts[:-1], strict=True))]
        parts = (np.concatenate([getattr(b, name) for b in found]) for name in ("hashes", "starts", "ends"))
        return Words(found[0].lo, found[-1].hi, *parts, np.concatenate(offsets), found[0].data)

    found, size = [], 0
    for block in word_blocks(column, LETTERS):
        found.append(block)
        size += int(block.ends[-1] - block.starts[0]) if len(block.ends) else 0
        if size >= size_of:
            yield merged(found)
            found, size = [], 0
    if found:
        yield merged(found)


def _first_of_runs(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)


def folded_documents(groups: DataFrame, min_df: int, parts: int) -> DataFrame:
    """Documents for fitting the vocabulary, from rows (lang, text, ...): ``part``, ``terms``, and the hashes of a sample of them.

    ``min_df`` documents of a block are enough to see whether a term is in ``min_df`` documents: the k-th of them holds the terms that
    k documents of the block or more hold. So a term is in as many of them as in the block's own, or in all ``min_df``, and
    the same terms reach ``min_df`` over all blocks. Each is cut into ``parts`` by the terms' hashes, so that equal terms can be brought together.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for block in _long_blocks(batch.column(1), FOLD):
                tags = [f"{lang} ".encode() for lang in langs[block.lo : block.hi]]
                keys = _term_keys(block, tags)
                order = np.argsort(keys, kind="stable")  # equal terms stay in the order of their texts
                text = np.repeat(np.arange(len(tags)), np.diff(block.offsets))[order]
                new_term = _first_of_runs(keys[order])
                new_pair = new_term | _first_of_runs(text)
                place = order[new_term]
                held = np.add.reduceat(new_pair.astype(np.int64), np.flatnonzero(new_term)) if len(place) else np.zeros(0, np.int64)
                for n in range(1, min_df + 1):
                    pick = np.zeros(len(keys), bool)
                    pick[place[held >= n]] = True
                    terms, mine = _tagged(block, pick, tags).flatten(), keys[pick]
                    part = ((mine >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
                    sorted_ = np.argsort(part, kind="stable")
                    sampled = mine[sorted_] // np.uint64(SAMPLE) % np.uint64(SAMPLE) == 0
                    present, sizes = np.unique(part, return_counts=True)
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    lists = [
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms.take(pa.array(sorted_))),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(sampled)])[ends], pa.int32()), pa.array(mine[sorted_][sampled].view(np.int64), pa.int64())
                        ),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), *lists], names=["part", "terms", "sampled"])

    return groups.mapInArrow(fold, "part int, terms array<string>, sampled array<long>")


class _Vocabulary:
    """Terms of a vectorizer by their hash, with their bytes."""

    def __init__(self, tagged: list[str]):
        langs, terms = zip(*(t.rsplit(" ", 1) for t in tagged), strict=True)
        blocks = list(word_blocks(pa.array(terms, pa.string()), LETTERS))
        keys = np.concatenate([_term_keys(b, [f"{lang} ".encode() for lang in langs[b.lo : b.hi]]) for b in blocks])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two kept terms share a 64-bit hash")
        self.codes = {lang: i for i, lang in enumerate(sorted(set(langs)))}
        self.langs = np.array([self.codes[lang] for lang in langs], np.int64)
        self.data, self.offsets = text_bytes(pa.array(terms, pa.string()))

    def vectors(self, block: Words, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Text (from 0) and index of every occurrence of a kept term; candidates by hash are compared by language and bytes."""
        keys = _term_keys(block, [f"{lang} ".encode() for lang in langs])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        near = np.flatnonzero(self.keys[at] == keys)
        index = self.order[at[near]]
        text = np.searchsorted(block.offsets, near, "right") - 1
        starts, lengths = block.starts[near], block.ends[near] - block.starts[near]
        code = np.array([self.codes.get(lang, -1) for lang in langs], np.int64)
        same = (self.offsets[index + 1] - self.offsets[index] == lengths) & (self.langs[index] == code[text])
        text, index, starts, lengths = text[same], index[same], starts[same], lengths[same]
        run = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.arange(run[-1])
        differ = LOWER[block.data[inside + np.repeat(starts - run[:-1], lengths)]] != self.data[inside + np.repeat(self.offsets[index] - run[:-1], lengths)]
        wrong = np.concatenate([[0], np.cumsum(differ)])
        right = wrong[run[1:]] == wrong[run[:-1]]
        return text[right], index[right]


def _group_sums(groups: DataFrame, vocabulary: _Vocabulary) -> DataFrame:
    """group, at, n: the sparse document vectors of rows (lang, text, group) summed by group and index, per task."""
    shared = groups.sparkSession.sparkContext.broadcast(vocabulary)  # bounded: the terms of one slice

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, numbers_of = shared.value, {}
        held, open_, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0

        def summed():
            keys, counts = (np.concatenate(x) for x in zip(held, *open_, strict=True))
            order = np.argsort(keys, kind="stable")
            first = np.flatnonzero(_first_of_runs(keys[order]))
            return keys[order][first], np.add.reduceat(counts[order], first) if len(first) else counts

        def out():
            names = np.fromiter(numbers_of, np.int64, len(numbers_of))
            keys, counts = held
            yield pa.RecordBatch.from_arrays([pa.array(names[keys >> 32]), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(counts)], names=["group", "at", "n"])

        for batch in batches:
            langs, of = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            numbers = np.array([numbers_of.setdefault(g, len(numbers_of)) for g in of], np.int64)
            for block in _long_blocks(batch.column(1), SUMMED):
                text, index = vocabulary.vectors(block, langs[block.lo : block.hi])
                keys, counts = np.unique((numbers[block.lo + text] << 32) | index, return_counts=True)
                open_.append((keys, counts))
                size += len(keys)
                if size >= HELD:
                    held, open_, size = summed(), [], 0
                    if len(held[0]) >= HELD:
                        yield from out()
                        held, numbers_of = (np.zeros(0, np.int64), np.zeros(0, np.int64)), {}
                        numbers = np.array([numbers_of.setdefault(g, len(numbers_of)) for g in of], np.int64)
        held = summed()
        yield from out()

    return groups.mapInArrow(add, "group long, at int, n long")


def group_counts(groups: DataFrame, min_df: int = 10, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """group, lang, term, n for every kept term that occurs in a group, from rows (lang, text, group).

    A term is kept if at least ``min_df`` documents of its language hold it. A vectorizer takes about ``slice_terms`` kept terms:
    a larger vocabulary is cut by hash into slices, each with its own vectorizer, so that no driver and no task holds more; each
    slice reads the texts once. How many terms are kept is estimated from those of one in ``SAMPLE`` hashes.
    """
    spark = groups.sparkSession
    parts = min(MOST_PARTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups.count() // DOCS_PER_PART))
    folded = saved(folded_documents(groups, min_df, parts).repartition(parts, "part"), "folded")
    held = folded.select(F.explode("sampled").alias("term")).groupBy("term").count().where(F.col("count") >= min_df).count()
    slices = 1 + int(held * SAMPLE * 1.1) // slice_terms
    nothing = spark.range(0, min_df, 1, 1).select(F.array(F.lit(_NOTHING)).alias("terms"))
    counted = []
    for k in range(slices):
        mine = folded.select("terms")
        if slices > 1:
            mine = mine.select(F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(slices)) == k).alias("terms"))  # noqa: B023
        vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MAX_VOCABULARY)
        vocabulary = [t for t in vectorizer.fit(mine.unionByName(nothing)).vocabulary if t != _NOTHING]
        if not vocabulary:
            continue
        names = pa.table({"at": pa.array(range(len(vocabulary)), pa.int32()), "tagged": pa.array(vocabulary, pa.string())})
        sums = _group_sums(groups, _Vocabulary(vocabulary)).groupBy("group", "at").agg(F.sum("n").alias("n"))
        # bounded: the vocabulary of a slice
        named = sums.join(F.broadcast(spark.createDataFrame(names)), "at")
        term = F.substring_index("tagged", " ", -1)
        lang = F.substring("tagged", F.lit(1), F.length("tagged") - F.length(term) - 1)
        counted.append(saved(named.select("group", lang.alias("lang"), term.alias("term"), "n"), "counts"))
    forget(folded)
    if not counted:
        return spark.createDataFrame([], "group long, lang string, term string, n long")
    return functools.reduce(DataFrame.unionByName, counted)


def _shares(counts: np.ndarray, size, n_terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (size + 2 terms)), exact for counts of any size."""
    if int(counts.max(initial=0)) + 2 > 9 * 10**9:
        counts = counts.astype(object)
    return (1 + 10**9 * (counts + 2) // (size + 2 * n_terms)).astype(np.int64)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Language:
    """One language in one task: its groups, the pair tables of its present terms, and the best terms of each group."""

    def __init__(self, lang: str, groups: list[tuple[str, int, int]], top: int):
        self.lang, self.top = lang, top
        groups = sorted(groups, key=lambda g: g[0].encode())
        self.names = [g[0] for g in groups]
        self.place = {name: i for i, name in enumerate(self.names)}
        self.sizes = np.array([g[1] for g in groups], np.int64)
        self.n_terms = groups[0][2]
        self.size = int(self.sizes.sum())
        if self.n_terms:
            self.absent = (1 + 2 * 10**9 // (self.sizes + 2 * self.n_terms)).astype(np.int64)
        self.tables: dict[tuple[int, int], np.ndarray] = {}
        self.best = [np.zeros(0, np.int64)] * 3  # group, value, number of the term
        self.words: dict[int, str] = {}
        self.seen = 0

    def base(self, piece: int, pieces: int) -> Iterator[tuple]:
        """What all terms of a pair give if the pair has none of them; a piece has its part of the groups."""
        for i in range(piece, len(self.names), pieces):
            values = self.n_terms * _gap(self.absent[i], self.absent) if self.n_terms else np.zeros(len(self.names), np.int64)
            for j in range(len(self.names)):
                if j != i:
                    yield _PAIR, self.lang, self.names[i], self.names[j], int(values[j])

    def add(self, term: np.ndarray, group: np.ndarray, count: np.ndarray, words: list[str]) -> Iterator[tuple]:
        """A run of whole terms: their numbers from 0, the groups and counts in which they occur. ``words`` names them."""
        share = _shares(count, self.sizes[group], self.n_terms)
        whole = np.zeros(len(words), np.int64)
        np.add.at(whole, term, count)
        ahead = share > (all_share := _shares(whole, self.size, self.n_terms))[term]
        self._rank(group[ahead], _gap(share[ahead], all_share[term[ahead]]), term[ahead] + self.seen, words)
        for low in range(0, len(self.names), SOURCES):
            yield from self._compare(term, group, share, len(words), low, min(low + SOURCES, len(self.names)))

    def _compare(self, term, group, share, n_words, low, high) -> Iterator[tuple]:
        dense = np.broadcast_to(self.absent[low:high], (n_words, high - low)).copy()
        here = np.zeros(dense.shape, bool)
        inside = (group >= low) & (group < high)
        dense[term[inside], group[inside] - low] = share[inside]
        here[term[inside], group[inside] - low] = True
        step = max(1, CELLS // (high - low))
        order = np.argsort(group, kind="stable")
        for at in range(0, len(order), step):
            rows = order[at : at + step]
            g, t = group[rows], term[rows]
            more = _gap(share[rows][:, None], dense[t]) - _gap(self.absent[g][:, None], self.absent[None, low:high])
            alone = np.where(here[t], 0, more)  # the other side counts the pair only where it has the term itself
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            for gi, a, b in zip(g[first], np.add.reduceat(more, first), np.add.reduceat(alone, first), strict=True):
                block, row = divmod(int(gi), SOURCES)
                self._table(block, low // SOURCES, high - low)[row] += a
                self._table(low // SOURCES, block, SOURCES)[: high - low, row] += b
            if len(self.tables) > TABLES:
                yield from self.pairs()

    def _table(self, i: int, j: int, width: int) -> np.ndarray:
        if (i, j) not in self.tables:
            self.tables[i, j] = np.zeros((SOURCES, SOURCES), np.int64)
        return self.tables[i, j][:, :width]

    def pairs(self) -> Iterator[tuple]:
        """What the present terms add to the base of each pair; sums may be handed out at any time."""
        for (i, j), table in self.tables.items():
            for r, c in zip(*np.nonzero(table), strict=True):
                a, b = i * SOURCES + int(r), j * SOURCES + int(c)
                if a != b:
                    yield _PAIR, self.lang, self.names[a], self.names[b], int(table[r, c])
        self.tables = {}

    def _rank(self, group, value, number, words) -> None:
        """Keep the ``top`` terms of each group; numbers follow the terms' byte order."""
        group, value, number = (np.concatenate(x) for x in zip(self.best, (group, value, number), strict=True))
        order = np.lexsort((number, -value, group))
        group, value, number = group[order], value[order], number[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        self.best = [x[rank < self.top] for x in (group, value, number)]
        kept = set(self.best[2].tolist())
        new = {self.seen + i: words[i] for i in (kept_i - self.seen for kept_i in kept) if i >= 0}
        self.words = {n: w for n, w in self.words.items() if n in kept} | new
        self.seen += len(words)

    def terms(self) -> Iterator[tuple]:
        for g, v, n in zip(*(x.tolist() for x in self.best), strict=True):
            yield _TERM, self.lang, self.names[g], self.words[n], v


_OUT = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _evaluate(top: int):
    """Stream rows sorted by lang, piece, kind (groups before terms) and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def packed(limit):
            nonlocal out
            if len(out) > limit:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
                out = []

        key, groups, language, rest = None, [], None, []

        def feed(rows, last):
            """Give the language its whole terms; the rows of the last term may go on in the next batch."""
            if not rows:
                return rows
            end = len(rows)
            if not last:
                while end and rows[end - 1][0] == rows[-1][0]:
                    end -= 1
            if end:
                words: list[str] = []
                number = []
                for term, _, _ in rows[:end]:
                    if not words or words[-1] != term:
                        words.append(term)
                    number.append(len(words) - 1)
                place = np.array([language.place[s] for _, s, _ in rows[:end]], np.int64)
                counts = np.array([n for _, _, n in rows[:end]], np.int64)
                out.extend(language.add(np.array(number, np.int64), place, counts, words))
            return rows[end:]

        def closed():
            nonlocal rest
            if language is not None:
                feed(rest, True)
                out.extend(language.pairs())
                out.extend(language.terms())
            rest = []

        for batch in batches:
            lists = [c.to_pylist() for c in batch.columns]
            for lang, piece, pieces, term, source, n, n_terms in zip(*lists, strict=True):
                if (lang, piece) != key:
                    closed()
                    key, groups, language = (lang, piece), [], None
                if term is None:
                    groups.append((source, n, n_terms))
                    continue
                if language is None:
                    language = _Language(lang, groups, top)
                    out.extend(language.base(piece, pieces))
                if source is not None:
                    rest.append((term, source, n))
                    if len(rest) >= 20_000:
                        rest = feed(rest, False)
            yield from packed(50_000)
        closed()
        yield from packed(0)

    return run


def divergence(
    docs: DataFrame, min_df: int = 10, top: int = 10, slice_terms: int = SLICE_TERMS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others, and by which terms.

    A group is a (language, source) that occurs, nulls being ''. ``pair``: one row per other source of the language, with the value
    summed over all kept terms. ``term``: the ``top`` kept terms of the group whose share is above the language's. Ranks go
    by value downwards, then by the item's bytes. A language without kept terms has pairs of value 0 and no terms; a language with one
    source has no pairs; no documents, no rows. Repeated rows count as often as they occur.

    No group is held by one task: a language's terms are spread over pieces by hash, each piece gets the sizes of the language's
    groups, and sums of pieces are added up. Shares are whole numbers, so nothing depends on the order.
    """
    texts = _groups(docs, text_col, lang_col, source_col).withColumn("group", F.xxhash64("lang", "source"))
    occurring = saved(texts.groupBy("group").agg(F.min("lang").alias("lang"), F.min("source").alias("source"), F.count_distinct("lang", "source").alias("names")), "groups")
    if not occurring.where("names > 1").isEmpty():
        raise ValueError("two groups share a 64-bit hash")
    counts = group_counts(texts.select("lang", "text", "group"), min_df, slice_terms)
    sizes = counts.groupBy("group").agg(F.sum("n").alias("size"))
    kept = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("n_terms"))
    pieces = counts.groupBy("lang").agg(F.ceil(F.count("*") / ROWS_PER_PIECE).cast("int").alias("pieces"))
    languages = saved(kept.join(pieces, "lang"), "languages")
    # how a join runs is left to Spark: groups and languages are usually few
    groups = occurring.join(sizes, "group", "left").join(languages, "lang", "left")
    groups = saved(groups.select("group", "lang", "source", F.coalesce("size", F.lit(0)).alias("n"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.coalesce("pieces", F.lit(1)).alias("pieces")), "groups")
    columns = ["lang", "piece", "pieces", "term", "source", "n", "n_terms"]
    nothing = F.lit(None).cast("string")
    heads = groups.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("term", nothing)
    # a term of no source begins the work on a piece, also where no term is kept
    starts = heads.withColumn("term", F.lit("")).withColumn("source", nothing).select(*columns[:5], F.lit(0).cast("long").alias("n"), "n_terms").distinct()
    cells = counts.drop("lang").join(groups.drop("n"), "group").withColumn("piece", F.pmod(F.xxhash64("term"), F.col("pieces")).cast("int")).select(*columns)
    rows = heads.select(*columns).unionByName(starts).unionByName(cells)
    rows = rows.repartition("lang", "piece").sortWithinPartitions("lang", "piece", F.col("term").asc_nulls_first(), "source")
    found = saved(rows.mapInArrow(_evaluate(top), "kind int, lang string, source string, item string, value long"), "found")
    pairs = found.where(F.col("kind") == _PAIR).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    best = found.where(F.col("kind") == _TERM).select("lang", "source", "item", "value", F.lit("term").alias("part"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order)), best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
