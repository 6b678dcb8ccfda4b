"""XML columns (I). The documents are built per row from the parts; the SQL builds what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import case, table
from tablesync.operators import xmlcols


def spelled(template: str):
    """A text per part; {brand}, {size}, {type} and {name} stand for its cells."""
    text = F.lit(template)
    for hole, cell in (("brand", "p_brand"), ("size", "p_size"), ("type", "p_type"), ("name", "p_name")):
        text = F.replace(text, F.lit("{" + hole + "}"), F.col(cell).cast("string"))
    return text


def spelled_sql(template: str) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for hole, cell in (("brand", "p_brand"), ("size", "p_size"), ("type", "p_type"), ("name", "p_name")):
        text = f"replace({text}, '{{{hole}}}', CAST({cell} AS VARCHAR))"
    return text


XML = '<Parameters><Parameter name="Brand">{brand}</Parameter><Parameter name="Size" unit="mm">{size}</Parameter><Note/></Parameters>'


def xml_parts(spark, d, template=XML):
    """Every part with its XML; economy parts hold malformed text."""
    text = F.when(F.col("p_type") == "ECONOMY", spelled("<broken>{name}")).otherwise(spelled(template))
    return table(spark, d, "part").select("p_partkey", "p_type", "p_name", text.alias("doc"))


def built(template: str) -> str:
    return f"SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '<broken>' || p_name ELSE {spelled_sql(template)} END AS doc FROM part"


@case(
    "i1_shred_xml",
    """SELECT p_partkey, v.*, CASE WHEN attr = 'unit' THEN 'mm' WHEN attr = 'no' THEN '007' WHEN node = 2 THEN p_brand
         WHEN node = 3 THEN CAST(p_size AS VARCHAR) WHEN node = 5 THEN p_name || ' & <' || p_brand || '>' END AS value
       FROM part, (VALUES (2, 1, 2, 1, 'Brand', NULL), (3, 1, 2, 2, 'Size', NULL), (3, 1, 2, 2, 'Size', 'unit'),
         (5, 4, 3, 1, 'Line', NULL), (6, 4, 3, 2, 'Line', NULL), (6, 4, 3, 2, 'Line', 'no')) v(node, parent, level, ord, elem_key, attr)
       WHERE p_type <> 'ECONOMY'""",
)
def _(spark, d):
    note = '<Note><!-- <x/> --><Line>{name} &amp; <![CDATA[<{brand}>]]></Line>\n<Line no="007"/></Note>'
    return xmlcols.shred_xml(xml_parts(spark, d, XML.replace("<Note/>", note)), ["p_partkey"], "doc")


@case("i2_drop_xml_elements", built('<Parameters><Parameter name="Brand">{brand}</Parameter><!-- note --><Group> <Other/></Group></Parameters>'))
def _(spark, d):
    group = '<!-- note --><Group><note><Size>{size}</Size></note> <Other/><P name="NOTE">x</P></Group>'
    return xmlcols.drop_xml_elements(xml_parts(spark, d, XML.replace("<Note/>", group)), ["doc"], ["SIZE", "note"]).select("p_partkey", "doc")


_LEAF = '<Parameter name="Size" unit="mm"><![CDATA[ {size}>  <{size} ]]></Parameter>'


@case(
    "i3_canonical_xml",
    built(f'<Parameters><Parameter name="Brand">{{brand}}</Parameter>{_LEAF}<Blank> </Blank><!-- >  < --><Note /></Parameters>'),
)
def _(spark, d):
    spaced = f'  <Parameters>\n <Parameter name="Brand">{{brand}}</Parameter>\t{_LEAF}\r\n<Blank> </Blank> <!-- >  < --> <Note  />\n</Parameters> '
    return xmlcols.canonical_xml(xml_parts(spark, d, spaced), ["doc"]).select("p_partkey", "doc")


# Target texts with what an incoming text does not know: foreign elements, attributes, comments, CDATA, blanks, spellings.
OWN = """<?xml version="1.0"?>
<Parameters  kind = '{type}'><!-- by <hand> --><Parameter name="Brand"> </Parameter>
  <Parameter name="OWN" unit="007">{type}</Parameter><Group><A><![CDATA[{name} <1>]]></A><B/></Group><Parameter name="Size" max="">{size}.0</Parameter></Parameters>"""
SEED = """<Parameters kind="other" lang='{brand}'><Parameter name="brand">{brand} &amp; co</Parameter><Parameter name="own">no</Parameter>
<Parameter name="SIZE" unit="mm" max="{size}">1</Parameter><Group><B no="1">{brand}</B><C><D>{size}</D></C><A>no</A></Group><Note/></Parameters>"""
FILLED = """<?xml version="1.0"?>
<Parameters  kind = '{type}' lang='{brand}'><!-- by <hand> --><Parameter name="brand">{brand} &amp; co</Parameter>
  <Parameter name="OWN" unit="007">{type}</Parameter><Group><A><![CDATA[{name} <1>]]></A><B no="1">{brand}</B><C><D>{size}</D></C></Group><Parameter name="Size" max="{size}" unit="mm">{size}.0</Parameter><Note/></Parameters>"""


def xml_pair(spark, d):
    parts = table(spark, d, "part")
    return parts.select("p_partkey", spelled(OWN).alias("doc")), parts.select("p_partkey", spelled(SEED).alias("doc"))


@case("i4_xml_fill", f"SELECT p_partkey, {spelled_sql(FILLED)} AS doc, '@lang,brand,@unit,@max,B,C,Note' AS filled FROM part")
def _(spark, d):
    rows = xmlcols.xml_fill(*xml_pair(spark, d), ["p_partkey"], "doc")
    return rows.select("p_partkey", "doc", F.array_join("filled", ",").alias("filled"))


#: (target, incoming, result, filled): one shape per part, in turn.
SHAPES = [
    ("<r><a>{size}</a></r>", "<r><a>1</a><b>{brand}</b></r>", "<r><a>{size}</a><b>{brand}</b></r>", "b"),
    ("<r><a></a></r>", "<r><a>{name}</a></r>", "<r><a>{name}</a></r>", "a"),
    ("<r><a>  </a></r>", "<r><a>{name}</a></r>", "<r><a>{name}</a></r>", "a"),
    ("<r><a>{name}</a><x>{type}</x></r>", "<r><a>other</a></r>", "<r><a>{name}</a><x>{type}</x></r>", ""),
    ("<r><a>1</a></r>", "<r lang='{brand}'><a>2</a></r>", "<r lang='{brand}'><a>1</a></r>", "@lang"),
    ("<r lang='{type}'/>", "<r lang='{brand}'/>", "<r lang='{type}'/>", ""),
    ("<r lang=' '/>", "<r lang='{brand}'/>", "<r lang='{brand}'/>", "@lang"),
    ("<r><o><a>{size}</a><b></b></o></r>", "<r><o><a>no</a><b>{brand}</b><c>{type}</c></o></r>", "<r><o><a>{size}</a><b>{brand}</b><c>{type}</c></o></r>", "b,c"),
    ('<s><p name="N">{name}</p></s>', '<s><p name="n">x</p><p name="M">{brand}</p></s>', '<s><p name="N">{name}</p><p name="M">{brand}</p></s>', "M"),
    ("<broken {name}", "<r><a>1</a></r>", "<broken {name}", ""),
    ("<r><a>{size}</a></r>", "<broken", "<r><a>{size}</a></r>", ""),
    ("<r><a>{size}</a></r>", '<!DOCTYPE r [<!ENTITY l "L">]><r><b>&l;</b></r>', "<r><a>{size}</a></r>", ""),
    ("<r> </r>", "<r>{name}</r>", "<r>{name}</r>", "r"),
    ("<r/>", "<r><a>{size}</a></r>", "<r><a>{size}</a></r>", "a"),
    (" ", "<r><a>{size}</a></r>", " ", ""),
]


def by_shape(pick: int):
    cell = F.lit(None).cast("string")
    for n, shape in enumerate(SHAPES):
        cell = F.when(F.col("p_partkey") % len(SHAPES) == n, spelled(shape[pick])).otherwise(cell)
    return cell


def by_shape_sql(pick: int) -> str:
    return "CASE p_partkey % {} {} END".format(len(SHAPES), " ".join(f"WHEN {n} THEN {spelled_sql(s[pick])}" for n, s in enumerate(SHAPES)))


@case("i4_xml_fill_shapes", f"SELECT p_partkey, {by_shape_sql(2)} AS doc, {by_shape_sql(3)} AS filled FROM part")
def _(spark, d):
    parts = table(spark, d, "part")
    target, incoming = (parts.select("p_partkey", by_shape(k).alias("doc")) for k in (0, 1))
    return xmlcols.xml_fill(target, incoming, ["p_partkey"], "doc").select("p_partkey", "doc", F.array_join("filled", ",").alias("filled"))


_EXTRA = '<Extra  no="{size}"><!--{type}--><B/></Extra>'


@case("i5_xml_overlay", f"SELECT p_partkey, {spelled_sql(SEED.replace('</Parameters>', _EXTRA + '</Parameters>'))} AS doc FROM part")
def _(spark, d):
    parts = table(spark, d, "part")
    target = parts.select("p_partkey", spelled(OWN.replace("<Group>", _EXTRA + "<Group>")).alias("doc"))
    return xmlcols.xml_overlay(target, xml_pair(spark, d)[1], ["p_partkey"], "doc")


@case(
    "i6_xml_types",
    "SELECT min(t) AS type_name FROM (SELECT upper(p_type) AS t FROM part UNION ALL SELECT lower(event_type) FROM events) u WHERE t <> '' GROUP BY lower(t)",
)
def _(spark, d):
    parts = table(spark, d, "part").select(F.upper("p_type").alias("t"))
    events = table(spark, d, "events").select(F.lower("event_type").alias("t"))
    return xmlcols.xml_types([(parts, "t"), (events, "t")])


@case(
    "i7_xml_element_inventory",
    """SELECT DISTINCT p_type AS type_name, k.e AS elem_key FROM part, (VALUES ('Note'), ('Parameter')) k(e) WHERE p_type <> 'ECONOMY'
       UNION ALL SELECT DISTINCT event_type, 'key-' || event_type FROM events UNION ALL SELECT DISTINCT event_type, 'REST' FROM events""",
)
def _(spark, d):
    params = F.concat(F.lit('<P><!--c--><I name="key-'), "event_type", F.lit('"><deep/></I><i>2</i><I name="REST"/><I name="Rest"/></P>'))
    events = table(spark, d, "events").select("event_type", params.alias("doc"))
    return xmlcols.xml_element_inventory([(xml_parts(spark, d), "p_type", "doc"), (events, "event_type", "doc")])


@case(
    "i8_sample_per_type",
    """WITH u AS (SELECT p_type AS type_name, 0 AS source_rank, p_partkey AS sample_key, p_name AS sample FROM part WHERE p_size > 20
         UNION ALL SELECT event_type, 1, event_id, props FROM events UNION ALL SELECT p_type, 1, p_partkey, p_brand FROM part),
       r AS (SELECT *, row_number() OVER (PARTITION BY type_name ORDER BY source_rank, sample_key) AS n FROM u)
       SELECT type_name, source_rank, sample_key, sample FROM r WHERE n = 1""",
)
def _(spark, d):
    parts, events = table(spark, d, "part"), table(spark, d, "events")
    second = events.select(F.col("event_type").alias("t"), F.col("props").alias("x"), F.col("event_id").alias("k"))
    second = second.unionByName(parts.select(F.col("p_type").alias("t"), F.col("p_brand").alias("x"), F.col("p_partkey").alias("k")))
    return xmlcols.sample_per_type([(parts.where("p_size > 20"), "p_type", "p_name", "p_partkey"), (second, "t", "x", "k")])


@case("i9_missing_declared_fields", "SELECT p_partkey, p_brand AS field FROM part WHERE p_size > 25")
def _(spark, d):
    field = F.when(F.col("p_size") > 25, F.lit("Other")).otherwise(F.col("p_brand"))
    doc = F.concat(F.lit('<item fieldForTitle="'), "p_brand", F.lit('"><fields><field systemName="'), field, F.lit('"/></fields></item>'))
    defs = table(spark, d, "part").select("p_partkey", doc.alias("doc"))
    return xmlcols.missing_declared_fields(defs, "p_partkey", "doc").select("p_partkey", "field")
