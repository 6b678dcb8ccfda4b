"""XML text columns of any shape: shredding, one spelling, taking elements out, filling, overlaying, inventories.

Elements are known by their ``name`` attribute, else by their local name, compared without case. Texts that are malformed or have a
document type are left as they are. Nothing that an operator does not state is rewritten: see ``xmltree``.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import is_blank
from tablesync.operators.merge import last_incoming
from tablesync.operators.placement import cut
from tablesync.operators.xmltree import EMPTY, OPEN, attribute_value, by_document, element_nodes, inner_value, kind_of, spliced, tokens
from tablesync.spec import TableSpec

_BASE, _EXTRA = 0, 1


def shred_xml(df: DataFrame, keys: list[str], col: str, name_attr: str = "name") -> DataFrame:
    """One row per value of an XML cell: keys, node, parent (node), level, ord, elem_key, attr, value.

    ``node`` numbers a text's elements by the place of their start tags, ``parent`` is NULL for the root, ``ord`` counts the
    siblings. ``attr`` is NULL for the text of an element without child elements, which is NULL where it is empty; attributes have a
    row each, but the one that names the element. ``keys`` must be unique. Malformed texts have no rows. Writes the texts once, at once.
    """
    cells = df.select(F.struct(*keys).alias("doc"), F.col(f"`{col}`").alias("text")).where(~is_blank(F.col("text")))
    docs = by_document(cells, F.length("text"))
    nodes = element_nodes(docs.select("doc", F.lit(_BASE).alias("side"), "text"), name_attr)
    nodes = nodes.where(F.col("well") & F.col("kind").isin(OPEN, EMPTY))
    siblings = Window.partitionBy("doc", "parent").orderBy("pos")
    nodes = nodes.withColumn("ord", F.row_number().over(siblings)).withColumn("node", F.row_number().over(Window.partitionBy("doc").orderBy("pos")))
    # an element stands beside its children: the smallest node of those that share an instance is the parent
    family = Window.partitionBy("doc", "of")
    placed = nodes.withColumn("of", F.explode(F.array("inst", "parent"))).withColumn("own", F.col("of") == F.col("inst"))
    placed = placed.withColumn("above", F.first(F.when(F.col("own"), F.col("node")), ignorenulls=True).over(family)).where(~F.col("own"))
    raw = F.substring("text", F.col("off") + F.col("len") + 1, F.col("close_off") - F.col("off") - F.col("len"))
    # texts compress well: by the size of their files they would be broadcast
    values = placed.join(docs.hint("merge"), "doc").withColumn("value", F.when(F.col("leaf"), F.nullif(inner_value(raw), F.lit(""))))
    own_text = F.struct(F.lit(None).cast("string").alias("attr"), F.col("value").alias("value"))
    named = F.filter("attrs", lambda a: a["name"] != name_attr)
    listed = F.concat(
        F.when(F.col("leaf"), F.array(own_text)).otherwise(F.array().cast("array<struct<attr:string,value:string>>")),
        F.transform(named, lambda a: F.struct(a["name"].alias("attr"), attribute_value(a["raw"]).alias("value"))),
    )
    rows = values.select("doc.*", "node", F.col("above").alias("parent"), "level", "ord", "elem_key", F.inline(listed))
    return rows


def canonical_xml(df: DataFrame, cols: list[str]) -> DataFrame:
    """One spelling of XML texts: no blanks around the text and between elements, `` />`` for empty elements written short.

    Blanks are removed only between tags, and only in texts whose elements hold either text or elements: a text with mixed content anywhere keeps
    all blanks. The blanks of a leaf, CDATA and comments stay as they are, and so does a text that is no sequence of tags and texts.
    """
    return df.withColumns({c: _canonical(F.col(f"`{c}`")) for c in cols})


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` mentions it."""
    return F.transform(F.array(value), f)[0]


def _canonical(text: Column) -> Column:
    own = F.trim(text)

    def kind(token: Column) -> Column:
        """As ``kind_of``; ``b`` for a text of blanks only."""
        found = kind_of(token)
        return F.when((found == "t") & token.rlike(r"^\s*+$"), "b").otherwise(found)

    def inside(kinds: Column, i: Column) -> Column:
        """Only text up to the tags on both sides, which open and close one element."""
        return F.coalesce(F.get(kinds, i - 1).isin("o", "t", "b", "d") & F.get(kinds, i + 1).isin("c", "t", "b", "d"), F.lit(False))

    def judged(s: Column) -> Column:
        mixed = F.exists(F.transform(s["kinds"], lambda k, i: k.isin("t", "d") & ~inside(s["kinds"], i)), lambda x: x)
        return _bound(F.struct(s["parts"].alias("parts"), s["kinds"].alias("kinds"), mixed.alias("mixed")), spelled)

    def spelled(s: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            k = F.get(s["kinds"], i)
            gone = ~s["mixed"] & (k == "b") & ~inside(s["kinds"], i)
            return F.when(gone, "").when(k == "e", F.regexp_replace(token, r"\s*/>$", " />")).otherwise(token)

        whole = (F.size(s["parts"]) > 1) & (F.array_join(s["parts"], "") == own)
        return F.when(whole, F.array_join(F.transform(s["parts"], one), "")).otherwise(own)

    return _bound(tokens(own), lambda parts: _bound(F.struct(parts.alias("parts"), F.transform(parts, kind).alias("kinds")), judged))


def _without(df: DataFrame, cols: list[str], names: Column, name_attr: str) -> DataFrame:
    """The elements named in an array of lower-case names taken out; names differ by row."""
    for col in cols:
        text = F.col(f"`{col}`")
        # texts that mention no name are not shuffled; an entity may hide one
        hit = F.coalesce(F.exists("_names", lambda n: F.contains(F.lower(text), n)) | F.contains(text, F.lit("&")), F.lit(False))
        rows = df.withColumn("_names", names).withColumn("_doc", F.when(hit, F.md5(F.concat_ws("\x00", text, F.array_join("_names", "\x01")))))
        found = rows.where("_doc is not null").groupBy(F.col("_doc").alias("doc")).agg(F.first(text).alias("text"), F.first("_names").alias("names"))
        found = by_document(found, F.length("text"))
        nodes = element_nodes(found.select("doc", F.lit(_BASE).alias("side"), "text", "names"), name_attr).where("well")
        nodes = nodes.join(found.select("doc", "names").hint("merge"), "doc")
        local = F.lower(F.substring_index("name", ":", -1))
        named = (F.col("level") > 1) & (F.array_contains("names", local) | F.coalesce(F.array_contains("names", F.lower("elem_key")), F.lit(False)))
        cuts = nodes.withColumn("named", named).where("named")
        inner = Window.partitionBy("doc").orderBy("off").rowsBetween(Window.unboundedPreceding, -1)
        cuts = cuts.withColumn("covered", F.max("end_off").over(inner)).where("covered is null or covered <= off")
        nothing = F.array().cast("array<struct<off:bigint,len:bigint>>")
        edit = F.struct(F.col("off").alias("at"), (F.col("end_off") - F.col("off")).alias("cut"), F.lit("").alias("before"), nothing.alias("slices"), F.lit("").alias("after"))
        edits = cuts.groupBy("doc").agg(F.sort_array(F.collect_list(edit)).alias("edits"))
        left = found.hint("merge").join(edits, "doc").select(F.col("doc").alias("_doc"), spliced(F.col("text"), F.col("edits"), F.col("text")).alias("_left"))
        changed = rows.where("_doc is not null").join(left.hint("merge"), "_doc", "left").withColumn(col, F.coalesce("_left", text)).select(*df.columns)
        df = rows.where("_doc is null").select(*df.columns).unionByName(changed)
    return df


def drop_xml_elements(df: DataFrame, cols: list[str], names: list[str], name_attr: str = "name") -> DataFrame:
    """Take the named elements, in any case and at any depth below the root, out of XML texts; the rest stays as it is written."""
    return _without(df, cols, F.array(*[F.lit(n.lower()) for n in names]), name_attr) if names else df


def drop_xml_elements_by_type(
    df: DataFrame, cols: list[str], type_col: str, names: list[str], by_type: dict[str, list[str]], name_attr: str = "name"
) -> DataFrame:
    """The same, with further names for rows of a type (compared without case)."""
    listed = {kind.lower(): sorted({n.lower() for n in [*names, *more]}) for kind, more in by_type.items()}
    always = F.array(*[F.lit(n.lower()) for n in names]).cast("array<string>")
    if not listed:
        return drop_xml_elements(df, cols, names, name_attr)
    per_type = F.from_json(F.lit(json.dumps(listed)), "map<string,array<string>>")
    return _without(df, cols, F.coalesce(F.try_element_at(per_type, F.lower(F.col(type_col))), always), name_attr)


def _merged(pairs: DataFrame, name_attr: str, fill: bool) -> DataFrame:
    """Merge pairs (doc, base, extra) of distinct docs, dealt by doc: doc, text, filled, well (the base).

    ``fill``: what the base lacks or leaves unset, at any depth, comes from the extra text, if both are well-formed. Otherwise
    the root's elements that only the extra text has are put behind the base's own.
    """
    sides = pairs.select("doc", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("text")) for s, c in ((_BASE, "base"), (_EXTRA, "extra"))])))
    nodes = element_nodes(sides, name_attr)
    base, extra = F.col("side") == _BASE, F.col("side") == _EXTRA
    doc = Window.partitionBy("doc")
    nodes = nodes.withColumns({
        "base_well": F.max(F.when(base, F.col("well"))).over(doc), "extra_well": F.max(F.when(extra, F.col("well"))).over(doc),
        "element": F.col("kind").isin(OPEN, EMPTY),
    })
    own = F.struct("kind", "tag", "name", "attrs", "level", "off", "len", "close_off", "end_off", "leaf", "unset")
    same_path = Window.partitionBy("doc", "path", "element")
    nodes = nodes.withColumn("match", F.first(F.when(base & F.col("first") & F.col("element"), own), ignorenulls=True).over(same_path))
    # the base's own elements have done their part; its first token tells whether it is well-formed
    nodes = nodes.where(extra | (F.col("pos") == 0))
    # an extra element stands beside its children, which see what it was matched with
    family = Window.partitionBy("doc", "side", "of")
    nodes = nodes.withColumn("of", F.explode(F.when(F.col("level") > 1, F.array("inst", "parent")).otherwise(F.array("inst", F.lit(None)))))
    is_parent = F.coalesce(F.col("of") == F.col("inst"), F.lit(False)) & F.col("first")
    nodes = nodes.withColumn("into", F.first(F.when(is_parent, F.col("match")), ignorenulls=True).over(family))
    nodes = nodes.where((F.col("of") != F.col("inst")) | F.col("of").isNull())

    match, into = F.col("match"), F.col("into")
    deep = F.col("level") > 1
    open_parent = into.isNotNull() & ((into["level"] == 1) | ~into["unset"])
    added = deep & open_parent & match.isNull()
    if not fill:
        added &= F.col("level") == 2
    alone = F.col("first") & match.isNotNull()
    replaced = alone & deep & match["unset"] if fill else F.lit(False)
    rooted = alone & ~deep & match["unset"] & F.col("leaf") & ~F.col("unset") if fill else F.lit(False)
    short = lambda n: n["kind"] == EMPTY
    slice_ = lambda off, end: F.array(F.struct(off.cast("long").alias("off"), (end - off).cast("long").alias("len")))
    whole, inside = slice_(F.col("off"), F.col("end_off")), slice_(F.col("off") + F.col("len"), F.col("close_off"))
    none = F.array().cast("array<struct<off:bigint,len:bigint>>")

    def edit(at, cut, before, slices, after):
        return F.struct(at.cast("long").alias("at"), cut.cast("long").alias("cut"), before.alias("before"), slices.alias("slices"), after.alias("after"))

    def at_end(n, slices):
        """Content put behind an element's own; one written short is opened."""
        opened = edit(n["end_off"] - 2, F.lit(2), F.lit(">"), slices, F.concat(F.lit("</"), n["name"], F.lit(">")))
        return F.when(short(n), opened).otherwise(edit(n["close_off"], F.lit(0), F.lit(""), slices, F.lit("")))

    content = F.when(short(match), at_end(match, inside)).otherwise(
        edit(match["off"] + match["len"], match["close_off"] - match["off"] - match["len"], F.lit(""), inside, F.lit(""))
    )
    element_edit = (
        F.when(added, at_end(into, whole))
        .when(replaced, edit(match["off"], match["end_off"] - match["off"], F.lit(""), whole, F.lit("")))
        .when(rooted, content)
    )

    # attributes: missing ones behind the others, blank ones in place
    held = lambda name: F.get(F.filter(match["attrs"], lambda a: a["name"] == name), 0)["raw"]
    blank = lambda raw: is_blank(attribute_value(raw))
    offered = F.filter("attrs", lambda a: (a["name"] != name_attr) & (a["name"] != "xmlns") & ~a["name"].startswith("xmlns:"))
    wanted = F.filter(offered, lambda a: F.coalesce(blank(held(a["name"])) & ~blank(a["raw"]), F.lit(False)) | held(a["name"]).isNull())
    taken = F.when(alone & ~replaced, wanted) if fill else F.lit(None).cast("array<struct<name:string,lead:string,raw:string>>")
    offer = lambda name: F.get(F.filter("taken", lambda a: a["name"] == name), 0)["raw"]
    kept = F.array_join(F.transform(match["attrs"], lambda a: F.concat(a["lead"], F.coalesce(offer(a["name"]), a["raw"]))), "")
    new = F.array_join(F.transform(F.filter("taken", lambda a: held(a["name"]).isNull()), lambda a: F.concat(F.lit(" "), a["name"], F.lit("="), a["raw"])), "")
    closing = F.when(short(match), 2).otherwise(1)
    blanks = F.regexp_extract(match["tag"], r"(\s*)/?>$", 1)
    tag = F.concat(F.lit("<"), match["name"], kept, new, blanks)
    tag_edit = F.when(F.size("taken") > 0, edit(match["off"], match["len"] - closing, tag, none, F.lit("")))
    nodes = nodes.withColumn("taken", taken).withColumns({"element_edit": element_edit, "tag_edit": tag_edit})
    names = F.concat(
        F.transform(F.coalesce("taken", F.array().cast("array<struct<name:string,lead:string,raw:string>>")), lambda a: F.concat(F.lit("@"), a["name"])),
        F.when(F.col("element_edit").isNotNull(), F.array("elem_key")).otherwise(F.array().cast("array<string>")),
    )
    usable = extra & F.col("element") & F.col("base_well") & F.col("extra_well")
    nodes = nodes.withColumn("edits", F.when(usable, F.filter(F.array("tag_edit", "element_edit"), lambda e: e.isNotNull())))
    nodes = nodes.withColumn("names", F.when(usable, names))
    found = nodes.select("doc", "pos", "base_well", "names", F.explode_outer("edits").alias("e"))
    # elements put at the end of one parent are one edit, in their order
    at = found.groupBy("doc", "e.at", "e.cut").agg(
        F.first("e.before", ignorenulls=True).alias("before"), F.first("e.after", ignorenulls=True).alias("after"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col("e").isNotNull(), F.struct("pos", "e.slices")))), lambda x: x["slices"])).alias("slices"),
        F.max("base_well").alias("well"), F.collect_set(F.struct("pos", "names")).alias("filled"),
    )
    per_doc = at.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "cut", "before", "slices", "after")))).alias("edits"),
        F.max("well").alias("well"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("filled")))).alias("filled"),
    )
    labels = F.flatten(F.transform(F.filter("filled", lambda x: x["names"].isNotNull()), lambda x: x["names"]))
    rows = pairs.hint("merge").join(per_doc, "doc")
    return rows.select("doc", spliced(F.col("base"), F.col("edits"), F.col("extra")).alias("text"), labels.alias("filled"), "well")


def _beside(target: DataFrame, incoming: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Target rows with ``_seed``, the incoming cell of their key (the last incoming row of a key counts)."""
    one = last_incoming(incoming, TableSpec("", tuple(keys)))
    seeds = one.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col(f"`{col}`").alias("_seed"))
    same = reduce(lambda a, b: a & b, [target[k] == F.col(f"_s{i}") for i, k in enumerate(keys)])
    # texts compress well: by the size of their files they would be broadcast
    return target.join(seeds.hint("merge"), same, "left").drop(*[f"_s{i}" for i in range(len(keys))])


def _with_merged(rows: DataFrame, base: str, extra: str, needs: Column, name_attr: str, fill: bool) -> DataFrame:
    """Rows with ``_text``, ``_filled`` and ``_well`` of their merged pair; equal pairs are merged once. Writes rows and pairs once, at once."""
    pair = F.md5(F.concat(F.md5(F.coalesce(base, F.lit(""))), F.md5(F.coalesce(extra, F.lit("")))))
    rows = cut(rows.withColumn("_doc", F.when(needs, pair)))
    pairs = rows.where("_doc is not null").groupBy(F.col("_doc").alias("doc")).agg(
        F.first(base).alias("base"), F.coalesce(F.first(extra), F.lit("")).alias("extra")
    )
    done = _merged(by_document(pairs, F.coalesce(F.length("base"), F.lit(0)) + F.length("extra")), name_attr, fill)
    done = done.select(F.col("doc").alias("_doc"), F.col("text").alias("_text"), F.col("filled").alias("_filled"), F.col("well").alias("_well"))
    rest = rows.where("_doc is null").withColumns({
        "_text": F.lit(None).cast("string"), "_filled": F.lit(None).cast("array<string>"), "_well": F.lit(None).cast("boolean"),
    })
    return rows.where("_doc is not null").join(done.hint("merge"), "_doc", "left").unionByName(rest)


def xml_fill(target: DataFrame, incoming: DataFrame, keys: list[str], col: str, name_attr: str = "name") -> DataFrame:
    """Destination wins inside one XML column: elements and attributes that are missing or unset take the incoming ones.

    An element without child elements whose text is blank gives way to the incoming element; a missing one is put behind its
    siblings-to-be with all that is in it; set ones are kept, and elements on both sides are merged in the same way. Roots
    belong together whatever their name. Of repeated elements the first counts. Adds ``filled``: keys of the elements, and attributes with
    an ``@``, in the incoming text's order. Cells that nothing fills, that are blank, that do not parse or whose
    incoming cell does not, and texts with a document type keep their text to the character.
    """
    both = ~is_blank(F.col(f"`{col}`")) & ~is_blank(F.col("_seed"))
    rows = _with_merged(_beside(target, incoming, keys, col), f"`{col}`", "_seed", both, name_attr, fill=True)
    return rows.select(
        *[F.coalesce("_text", F.col(f"`{c}`")).alias(c) if c == col else F.col(f"`{c}`") for c in target.columns],
        F.coalesce("_filled", F.array().cast("array<string>")).alias("filled"),
    )


def xml_overlay(target: DataFrame, incoming: DataFrame, keys: list[str], col: str, name_attr: str = "name") -> DataFrame:
    """Source wins inside one XML column: the incoming text, and behind its root's elements those that only the target has.

    Without an incoming cell that parses the target keeps its text; a target that does not parse gives way whole.
    """
    rows = _with_merged(_beside(target, incoming, keys, col), "_seed", f"`{col}`", ~is_blank(F.col("_seed")), name_attr, fill=False)
    new = F.when(F.coalesce("_well", F.lit(False)), F.col("_text")).otherwise(F.col(f"`{col}`"))
    return rows.select(*[new.alias(c) if c == col else F.col(f"`{c}`") for c in target.columns])


def xml_types(parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct type names over several tables, matched without case: the smallest spelling of each."""
    names = [df.select(F.col(c).cast("string").alias("t")).where("t <> ''") for df, c in parts]
    both = reduce(DataFrame.unionByName, names)
    return both.groupBy(F.lower("t").alias("_t")).agg(F.min("t").alias("type_name")).select("type_name")


def xml_element_inventory(parts: list[tuple[DataFrame, str, str]], name_attr: str = "name") -> DataFrame:
    """Distinct (type_name, elem_key) of the root's elements over all documents of several tables: (rows, type column, XML column).

    Where all elements of a root share one tag and one has a name, the names count (blank ones do not), else the tags; keys are
    told apart without case, the smallest spelling stands for them. Equal documents of a type are read once; malformed ones are skipped.
    """
    texts = [
        df.select(F.col(kind).cast("string").alias("type_name"), F.col(col).alias("text")).where((F.col(kind).cast("string") != "") & ~is_blank(F.col(col)))
        for df, kind, col in parts
    ]
    # the type belongs to the document: equal texts of one type are one
    both = reduce(DataFrame.unionByName, texts).groupBy(F.struct("type_name", F.md5("text").alias("text")).alias("doc")).agg(F.first("text").alias("text"))
    both = by_document(both, F.length("text"))
    nodes = element_nodes(both.select("doc", F.lit(_BASE).alias("side"), "text"), name_attr).where((F.col("level") == 2) & F.col("well"))
    local, named = F.substring_index("name", ":", -1), F.exists("attrs", lambda a: (a["name"] == name_attr) & (F.length(a["raw"]) > 2))
    doc = Window.partitionBy("doc")
    nodes = nodes.withColumn("by_name", (F.min(F.lower(local)).over(doc) == F.max(F.lower(local)).over(doc)) & F.max(named).over(doc))
    keys = nodes.select("doc.type_name", F.when(~F.col("by_name"), local).when(named, F.col("elem_key")).alias("elem_key")).where("elem_key is not null")
    found = keys.groupBy("type_name", F.lower("elem_key").alias("_key")).agg(F.min("elem_key").alias("elem_key"))
    return found.select("type_name", "elem_key")


def sample_per_type(sources: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """One sample document per type: from the first source that has one, there the lowest key."""
    union = None
    for rank, (df, type_col, xml_col, key) in enumerate(sources):
        part = df.where((F.col(type_col) != "") & ~is_blank(F.col(xml_col))).select(
            F.col(type_col).alias("type_name"),
            F.lit(rank).alias("source_rank"),
            F.col(key).cast("long").alias("sample_key"),
            F.col(xml_col).alias("sample"),
        )
        union = part if union is None else union.unionByName(part)
    # Find the place of each sample first: only ranks and keys are grouped, never the documents.
    place = F.min(F.struct("source_rank", "sample_key")).alias("_best")
    best = union.groupBy(F.col("type_name").alias("_t")).agg(place).select("_t", "_best.*")
    best = best.toDF("_t", "_rank", "_key")
    at = (F.col("type_name") == F.col("_t")) & (F.col("source_rank") == F.col("_rank")) & (F.col("sample_key") == F.col("_key"))
    return union.join(best, at, "left_semi")


def missing_declared_fields(
    defs: DataFrame, key: str, col: str, declared_attr: str = "fieldForTitle", list_tag: str = "fields", field_tag: str = "field",
    field_attr: str = "systemName",
) -> DataFrame:
    """Definitions whose root names a field (an attribute) that their list of fields does not contain."""
    field = T.StructType([T.StructField(f"_{field_attr}", T.StringType())])
    fields = T.StructType([T.StructField(field_tag, T.ArrayType(field))])
    schema = T.StructType([T.StructField(f"_{declared_attr}", T.StringType()), T.StructField(list_tag, fields)])
    doc = defs.select(key, F.from_xml(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("_doc"))
    declared = F.col(f"_doc._{declared_attr}")
    none = F.array().cast(T.ArrayType(field))
    held = F.exists(F.coalesce(F.col(f"_doc.{list_tag}.{field_tag}"), none), lambda f: F.coalesce(f[f"_{field_attr}"] == declared, F.lit(False)))
    return doc.where((declared != "") & ~held).select(key, declared.alias("field"))
