"""XML texts of any shape as tables of nodes, and edits of a text at stated places.

A text is cut into its tokens (tags, text, CDATA, comments, instructions) by one expression, tokens become rows beside their document,
and windows over a document give every node its place, its level, its parent and the path of keys that leads to it. All
windows share one shuffle, by document. What an operator changes is a list of edits at character positions; the edits are spliced into the
document's own text, so every character outside an edit stays as it is written, blanks, comments, entities and numbers included.

Texts that are not well-formed, and texts with a document type, have no nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.placement import cut

CHARS = 2_000_000  # of the documents of one task; a character takes up to about 70 bytes as tokens and nodes
_ATTR = r"""\s+[^\s<>/=]+\s*=\s*(?:"[^"<]*+"|'[^'<]*+')"""
TOKEN = (
    r"<!--(?s:.*?)-->|<!\[CDATA\[(?s:.*?)\]\]>|<\?(?s:.*?)\?>"
    rf"|</?[^\s<>/!?][^\s<>/]*+(?:{_ATTR})*+\s*/?>|[^<]++"
)
_BLANK = r"(?U)^(?:\s|&#(?:32|9|10|13|[xX]0*(?:20|9|[aA]|[dD]));)*+$"
_BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"

# In the order in which they must be undone.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))

OPEN, CLOSE, EMPTY, TEXT, DATA, OTHER = "o", "c", "e", "t", "d", "x"


def by_document(texts: DataFrame, size: Column) -> DataFrame:
    """Rows with a ``doc``, written and dealt by it into as many parts as their characters ask for; ``size`` counts those of a row.

    Tokens need far more room than the texts that are shuffled, which compress well: the bytes of a shuffle say little about a task. Runs at once.
    """
    texts = cut(texts)
    chars = texts.agg(F.sum(size.cast("long"))).first()[0] or 0
    return texts.repartition(max(1, -(-chars // CHARS)), "doc")


def tokens(text: Column) -> Column:
    """The tokens of a text; put together they are the text, unless it is malformed."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def kind_of(token: Column) -> Column:
    return (
        F.when(~token.startswith("<"), TEXT)
        .when(token.startswith("<!--") | token.startswith("<?"), OTHER)
        .when(token.startswith("<!["), DATA)
        .when(token.startswith("</"), CLOSE)
        .when(token.endswith("/>"), EMPTY)
        .otherwise(OPEN)
    )


def unescaped(text: Column) -> Column:
    """The five named entities as characters; numbered ones stay as they are written."""
    for entity, plain in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def inner_value(raw: Column) -> Column:
    """The text that markup between two tags stands for: CDATA opened, entities undone, comments left out."""

    def plain(token: Column) -> Column:
        data = F.substring(token, F.lit(10), F.length(token) - 12)
        kind = kind_of(token)
        return F.when(kind == TEXT, unescaped(token)).when(kind == DATA, data).otherwise("")

    return F.array_join(F.transform(tokens(raw), plain), "")


def _attributes(tag: Column) -> Column:
    """Attributes of a tag as (name, lead, raw): what stands before the quoted value, and the value with its quotes."""

    def parts(a: Column) -> Column:
        lead = F.regexp_extract(a, r"^(\s+[^\s=]+\s*=\s*)", 1)
        return F.struct(F.regexp_extract(a, r"^\s+([^\s=]+)", 1).alias("name"), lead.alias("lead"), F.substring(a, F.length(lead) + 1, F.length(a)).alias("raw"))

    return F.transform(F.regexp_extract_all(tag, F.lit(_ATTR), F.lit(0)), parts)


def attribute_value(raw: Column) -> Column:
    return unescaped(F.substring(raw, F.lit(2), F.length(raw) - 2))


def element_nodes(texts: DataFrame, name_attr: str = "name") -> DataFrame:
    """One row per element of each text, and one for the first token, from rows (doc, side, text).

    ``texts`` must be partitioned by ``doc``; a doc may have several texts, told apart by ``side``. Columns: doc, side, pos, kind
    (``o``, ``e``, or another one for a first token that is no element), tag (the start tag), name, elem_key (the ``name_attr`` attribute if the
    element has it, else the name without prefix), attrs, level (the root is 1), nth among the siblings of its key, off and
    len of the start tag, close_off and end_off, leaf, unset (a leaf of blanks only), inst and parent (of this very element), path (equal for
    elements that are reached by equal keys, without case; the root's key does not count), first (it and all above it are the first
    of their key), well (the text is well-formed). Lists of equal keys go in document order.
    """
    cells = texts.select("doc", "side", F.length("text").alias("size"), F.posexplode(tokens(F.col("text"))).alias("pos", "tok"))
    kind, tok = F.col("kind"), F.col("tok")
    begins, paired = kind.isin(OPEN, EMPTY), kind.isin(OPEN, CLOSE)
    text = F.when(kind == DATA, F.substring(tok, F.lit(10), F.length(tok) - 12)).when(kind == TEXT, tok)
    rows = cells.withColumn("kind", kind_of(tok)).withColumns({
        "len": F.length("tok"),
        "set": F.coalesce(~text.rlike(_BLANK), F.lit(False)),
        "name": F.when(begins | (kind == CLOSE), F.regexp_extract(tok, r"^</?([^\s/>]+)", 1)),
        "attrs": F.when(begins, _attributes(tok)),
    })

    whole = Window.partitionBy("doc", "side")
    order = whole.orderBy("pos")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "off": F.sum("len").over(until) - F.col("len"),
        "depth": F.sum(F.when(kind == OPEN, 1).when(kind == CLOSE, -1).otherwise(0)).over(until),
        "full": F.sum(F.col("set").cast("int")).over(until),
    })
    wrong = (
        (F.col("depth") < 0)
        | ((F.col("depth") == 0) & (F.col("set") | (kind == DATA)))
        | (kind.isin(TEXT, OPEN, EMPTY) & tok.rlike(_BARE_AMPERSAND))
        | ((kind == TEXT) & F.contains(tok, F.lit("]]>")))
        | ((kind == CLOSE) & ~tok.rlike(r"^</[^\s/>]+\s*>$"))
        | (begins & (F.size(F.array_distinct(F.transform("attrs", lambda a: a["name"]))) < F.size("attrs")))
        | ((kind == OTHER) & (F.lower(F.substring(tok, 1, 6)) == "<?xml ") & (F.col("pos") > 0))
    )
    roots = F.sum((begins & (F.col("depth") + (kind == EMPTY).cast("int") == 1)).cast("int")).over(whole)
    sound = ~F.max(wrong).over(whole) & (F.sum("len").over(whole) == F.col("size")) & (roots == 1)
    # from here on texts, CDATA and comments have done their part
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False))).where(begins | (kind == CLOSE) | (F.col("pos") == 0))

    named = F.filter("attrs", lambda a: a["name"] == name_attr)
    rows = rows.withColumn("level", F.col("depth") + kind.isin(EMPTY, CLOSE).cast("int")).withColumn(
        "elem_key", F.when(begins, F.coalesce(attribute_value(F.get(named, 0)["raw"]), F.substring_index("name", ":", -1)))
    )

    # opening and closing tags of one level take turns
    turn = Window.partitionBy("doc", "side", F.when(paired, F.col("level")).otherwise(-1)).orderBy("pos")
    folded = F.when(F.col("level") > 1, F.lower("elem_key")).otherwise("")
    rows = rows.withColumns({
        "before": F.struct("kind", "name", "pos", folded.alias("key")),
        "after": F.struct("kind", "name", "off", "len", "full"),
    })
    rows = rows.withColumn("before", F.when(kind == CLOSE, F.lag("before").over(turn))).withColumn("after", F.when(kind == OPEN, F.lead("after").over(turn)))
    key = F.when(kind == CLOSE, F.col("before.key")).when(begins, folded)
    rows = rows.withColumns({
        "own": F.xxhash64(F.when(kind == CLOSE, F.col("before.pos")).otherwise(F.col("pos"))),
        "key": key,
        "step": F.xxhash64("level", key),
    })

    # what an element adds when it opens is taken away when it closes
    here = lambda c: F.coalesce(F.bit_xor(F.when(paired, F.col(c))).over(until), F.lit(0))
    unpaired = (
        ((kind == OPEN) & ~F.coalesce((F.col("after.kind") == CLOSE) & (F.col("after.name") == F.col("name")), F.lit(False)))
        | ((kind == CLOSE) & ~F.coalesce(F.col("before.kind") == OPEN, F.lit(False)))
    )
    rows = rows.withColumns({"inst": here("own"), "path": here("step"), "well": F.col("sound") & ~F.max(unpaired).over(whole)})
    rows = rows.withColumns({
        "parent": F.when(kind == OPEN, F.col("inst").bitwiseXOR(F.col("own"))).otherwise(F.col("inst")),
        "inst": F.when(kind == EMPTY, F.col("inst").bitwiseXOR(F.col("own"))).otherwise(F.col("inst")),
        "path": F.when(kind == EMPTY, F.col("path").bitwiseXOR(F.col("step"))).otherwise(F.col("path")),
    })

    sibling = Window.partitionBy("doc", "side", "parent", "key", begins).orderBy("pos")
    rows = rows.withColumn("nth", F.row_number().over(sibling))
    rows = rows.withColumn("repeats", F.when(kind == CLOSE, F.lag("nth").over(turn)).otherwise(F.col("nth")) > 1)
    later = F.sum(F.when(kind == OPEN, F.col("repeats").cast("int")).when(kind == CLOSE, -F.col("repeats").cast("int")).otherwise(0)).over(until)
    rows = rows.withColumn("first", (later + ((kind == EMPTY) & F.col("repeats")).cast("int")) == 0)
    leaf = (kind == EMPTY) | (F.lead("kind").over(order) == CLOSE)
    rows = rows.withColumn("leaf", leaf).where(kind != CLOSE)
    end = F.col("off") + F.col("len")
    return rows.select(
        "doc", "side", "pos", "kind", tok.alias("tag"), "name", "elem_key", "attrs", "level", "nth", "off", "len",
        F.coalesce(F.col("after.off"), end).alias("close_off"), F.coalesce(F.col("after.off") + F.col("after.len"), end).alias("end_off"),
        "leaf", (F.col("leaf") & ((kind == EMPTY) | (F.col("after.full") == F.col("full")))).alias("unset"), "inst", "parent", "path", "first", "well",
    )


def spliced(text: Column, edits: Column, source: Column) -> Column:
    """The text with its edits, a sorted array of (at, cut, before, slices, after).

    At character ``at`` (from 0), ``cut`` characters give way to ``before``, the ``slices`` (off, len) of ``source``, and ``after``. Edits do not overlap.
    """

    def piece(e: Column, i: Column) -> Column:
        last = F.get(edits, i - 1)
        end = F.coalesce(last["at"] + last["cut"], F.lit(0))
        taken = F.array_join(F.transform(e["slices"], lambda s: F.substring(source, (s["off"] + 1).cast("int"), s["len"].cast("int"))), "")
        return F.concat(F.substring(text, (end + 1).cast("int"), (e["at"] - end).cast("int")), e["before"], taken, e["after"])

    tail = F.get(edits, F.size(edits) - 1)
    rest = F.substring(text, (tail["at"] + tail["cut"] + 1).cast("int"), F.length(text))
    return F.when(F.size(edits) > 0, F.concat(F.array_join(F.transform(edits, piece), ""), rest)).otherwise(text)
