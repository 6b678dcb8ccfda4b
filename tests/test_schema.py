import datetime as dt
import decimal

from conftest import values
from pyspark.sql import types as T

from tablesync.operators import schema
from tablesync.operators.schema import ColumnDef

DEFS = [
    ColumnDef("s", "nvarchar", 50), ColumnDef("d", "datetime"), ColumnDef("o", "datetimeoffset"), ColumnDef("day", "date"),
    ColumnDef("b", "bit"), ColumnDef("i", "int"), ColumnDef("l", "bigint"), ColumnDef("m", "decimal", None, 9, 2),
    ColumnDef("f", "float"), ColumnDef("r", "real"), ColumnDef("g", "uniqueidentifier"), ColumnDef("bin", "varbinary", -1),
]
GOAL = schema.struct_from_defs(DEFS)
TEXT = ", ".join(f"{d.name} string" for d in DEFS)
GUID = "0F8FAD5B-D9CB-469F-A165-70867728950E"


def coerced(rows, *cells):
    df = rows([tuple(cells)], TEXT)
    out, rejects = schema.coerce(df, GOAL, ["s"])
    return out.first(), rejects


def test_values_parse(rows):
    r, rejects = coerced(
        rows, "Shop 2", "2019-11-23T07:41:18.2650000", "2019-11-23T07:41:18+02:00", "2019-11-23", "True", " 42 ", "9999999999",
        "1,234.50", "3.14", "1.5", "{" + GUID.replace("-", "") + "}", "aGk=",
    )
    assert r["s"] == "Shop 2" and r["d"] == dt.datetime(2019, 11, 23, 7, 41, 18, 265000)
    assert r["o"] == dt.datetime(2019, 11, 23, 5, 41, 18) and r["day"] == dt.date(2019, 11, 23)
    assert (r["b"], r["i"], r["l"], r["m"]) == (True, 42, 9999999999, decimal.Decimal("1234.50"))
    assert (r["f"], r["r"], r["g"], bytes(r["bin"])) == (3.14, 1.5, GUID.lower(), b"hi")
    assert rejects.count() == 0


def test_short_forms(rows):
    r, _ = coerced(rows, "", "2019-11-23 12:00", "11/23/2019 3:05:06", "2019-11-23", "0", "-1", "+7", ".5", "1e3", "1", GUID, None)
    assert r["s"] == "" and r["d"] == dt.datetime(2019, 11, 23, 12) and r["o"] == dt.datetime(2019, 11, 23, 3, 5, 6)
    assert (r["b"], r["i"], r["l"], r["m"], r["f"]) == (False, -1, 7, decimal.Decimal("0.50"), 1000.0)


def test_blank_is_null_except_in_text(rows):
    r, rejects = coerced(rows, "  ", *[" \t"] * 11)
    assert r["s"] == "  " and all(r[d.name] is None for d in DEFS[1:]) and rejects.count() == 0


def test_unparseable_is_null_and_reported(rows):
    r, rejects = coerced(rows, "k", *["junk!"] * 11)
    assert all(r[d.name] is None for d in DEFS[1:])
    assert values(rejects, "s", "col") == sorted(("k", d.name) for d in DEFS[1:])


def test_number_spellings_that_other_parsers_accept(rows):
    r, rejects = coerced(rows, "k", None, None, None, "yes", "5.0", "1e2", "1e2", "5d", "NaN", None, None)
    assert (r["b"], r["i"], r["l"], r["m"], r["f"], r["r"]) == (None,) * 6 and rejects.count() == 6


def test_unknown_column_passes_and_int_widens(rows):
    out, _ = schema.coerce(rows([("x", 5)], "other string, l int"), GOAL)
    assert out.first()["other"] == "x" and out.schema["l"].dataType == T.LongType()


def test_align(rows):
    goal = T.StructType().add("A", "string").add("missing", "string")
    df, warnings = schema.align_to_schema(rows([("1", "2", "3")], "a string, b string, c string"), goal, "t")
    assert df.columns == ["A"] and values(warnings, "column_name") == [("b",), ("c",)]


def test_not_null_defaults(rows):
    goal = T.StructType().add("s", "string", False).add("n", "integer", False).add("b", "boolean", False)
    goal = goal.add("d", "date", False).add("opt", "string", True)
    df = schema.fill_not_null(rows([(None,) * 5], "S string, n int, b boolean, d date, opt string"), goal)
    assert tuple(df.first()) == ("", 0, False, None, None)


def test_empty_table_from_definitions(spark):
    defs = [ColumnDef("Id", "int", nullable=False, identity=True), ColumnDef("Name", "nvarchar", 50), ColumnDef("P", "money")]
    df = schema.empty_from_schema(spark, defs, keys=("ID",))
    meta = df.schema["Id"].metadata
    assert df.count() == 0 and meta["isIdentity"] and meta["isKey"] and not df.schema["Id"].nullable
    assert df.schema["Name"].metadata["maxLength"] == 50 and df.schema["P"].dataType == T.DecimalType(19, 4)


def test_defined_columns(rows):
    defs = rows([("Flag", 1), ("note", 2), ("ID", 2), ("odd", 9)], "name string, type_id int")
    kinds = rows([(1, "boolean"), (2, "string")], "type_id int, spark_type string")
    df, log = schema.add_defined_columns(rows([(1,)], "id int"), defs, kinds)
    assert tuple(df.first()) == (1, False, None) and df.columns == ["id", "Flag", "note"]
    assert dict(values(log)) == {"Flag": "added", "note": "added", "ID": "exists", "odd": "unknown type"}


def test_missing_columns_idempotent(rows):
    goal = T.StructType().add("ID", "integer").add("x", "string")
    once = schema.add_missing_columns(rows([(1,)], "id int"), goal)
    assert once.columns == ["id", "x"] and schema.add_missing_columns(once, goal).columns == ["id", "x"]


def test_schema_diff(spark):
    a = T.StructType().add("a", "string").add("B", "integer").add("c", "string", False)
    b = T.StructType().add("A", "string").add("b", "long").add("c", "string").add("d", "string")
    assert dict(values(schema.schema_diff(spark, a, b), "column_name", "change")) == {"B": "type", "c": "nullability", "d": "only_b"}


def test_field_drift(rows):
    old = rows([("a", '{"x": 1, "y": "s", "z": {"q": 1}}'), ("a", '{"x": null}'), ("b", "bad"), ("b", "[1]"), (None, '{"m": 1}')], "t string, j string")
    new = rows([("a", '{"x": 2.5, "z": {"q": "1"}, "w": true}'), ("a", '{"y": "t"}'), ("b", '{"k": 1}'), (None, '{"m": 2}'), ("c", None)], "t string, j string")
    assert values(schema.field_drift(old, new, "t", "j"), "type_name", "field", "change", "old_kind", "new_kind") == [
        ("a", "w", "new", None, "BOOLEAN"), ("a", "x", "retyped", "BIGINT", "DECIMAL(2,1)"), ("a", "z", "retyped", "OBJECT<q: BIGINT>", "OBJECT<q: STRING>"),
        ("b", "k", "new", None, "BIGINT"),
    ]
    assert schema.field_drift(old, old, "t", "j").count() == 0
