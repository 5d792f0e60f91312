"""Goldens for type names, defaults and value conformance."""

import datetime
import decimal
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ferrycraft.functions import sql_types as st
from ferrycraft.functions import text as tx
from ferrycraft.functions.sql_types import ColumnSpec
from ferrycraft.operators import conform as cf

# (type, length, precision, scale) -> PostgreSQL, MySQL, BSON names.
MAPPED = [
    (("varchar", -1, None, None), ("text", "LONGTEXT", "string")),
    (("nvarchar", 255, None, None), ("varchar(255)", "VARCHAR(255)", "string")),
    (("VARCHAR ", 16383, None, None), ("varchar(16383)", "VARCHAR(16383)", "string")),
    (("varchar", 16384, None, None), ("varchar(16384)", "MEDIUMTEXT", "string")),
    (("varchar", None, None, None), ("text", "LONGTEXT", "string")),
    (("char", 255, None, None), ("varchar(255)", "CHAR(255)", "string")),
    (("nchar", 256, None, None), ("varchar(256)", "VARCHAR(255)", "string")),
    (("decimal", None, 10, 2), ("numeric(10,2)", "DECIMAL(10,2)", "decimal128")),
    (("decimal", None, 10, 0), ("numeric(10,0)", "DECIMAL(10,0)", "decimal128")),
    (("numeric", None, 10, None), ("numeric(10)", "DECIMAL(10,0)", "decimal128")),
    (("numeric", None, None, None), ("numeric", "DECIMAL(18,4)", "decimal128")),
    (("float", None, 24, None), ("real", "FLOAT", "double")),
    (("float", None, 25, None), ("double precision", "DOUBLE", "double")),
    (("float", None, None, None), ("double precision", "DOUBLE", "double")),
    (("tinyint", None, None, None), ("smallint", "TINYINT UNSIGNED", "int")),
    (("bit", None, None, None), ("boolean", "TINYINT(1)", "bool")),
    (("datetime2", None, None, None), ("timestamptz", "DATETIME(6)", "date")),
    (("datetimeoffset", None, None, None), ("timestamptz", "DATETIME(6)", "date")),
    (("uniqueidentifier", None, None, None), ("uuid", "CHAR(36)", "string")),
    (("hierarchyid", None, None, None), ("text", "VARCHAR(256)", "string")),
    (("rowversion", None, None, None), ("bytea", "BIGINT UNSIGNED", "long")),
    (("whatever", None, None, None), ("text", "LONGTEXT", "string")),
]
DEFAULTS = [
    ("((1))", "boolean", "true", "1"), ("((0))", "boolean", "false", "0"), ("((1))", "integer", "1", "1"),
    ("(getdate())", "timestamp", "CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP"),
    ("(GETUTCDATE())", "timestamp", "NOW()", "CURRENT_TIMESTAMP"),
    ("(sysdatetime())", "timestamp", "CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP(6)"),
    ("(newid())", "uuid", "gen_random_uuid()", "(UUID())"), ("(NULL)", "text", "NULL", "NULL"),
    ("(N'')", "text", "''", "''"), ("(N'a (b)')", "text", "'a (b)'", "'a (b)'"), ("('x')", "text", "'x'", "'x'"),
    ("(-1.5e3)", "text", "-1.5e3", "-1.5e3"), ("(1_000)", "integer", "1_000", "1_000"), ("(.5)", "text", ".5", ".5"),
    ("(1)+(2)", "integer", None, None), ("(user_name())", "text", None, None), ("", "text", None, None),
    (None, "text", None, None), ("( ( 7 ) )", "integer", "7", "7"), ("(1.2.3)", "text", None, None),
]
PARENS = [("((a)+(b))", "(a)+(b)"), ("(a)+(b)", "(a)+(b)"), ("(((x>(0))))", "x>(0)"), ("(f(g(1)))", "f(g(1))"),
          ("a", "a"), ("()", ""), ("(a", "(a"), ("((a)", "(a")]


def test_type_names(spark):
    rows = [(i, *source) for i, (source, _) in enumerate(MAPPED)]
    df = spark.createDataFrame(rows, "i int, t string, n int, p int, s int")
    out = df.select("i", *[st.map_type(x, F.col("t"), F.col("n"), F.col("p"), F.col("s")) for x in ("pg", "mysql", "bson")])
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {i: names for i, (_, names) in enumerate(MAPPED)}


@pytest.mark.parametrize("profile,table", [("pg", st.PG_TYPES), ("mysql", st.MYSQL_TYPES), ("bson", st.BSON_TYPES)])
def test_every_plain_type(spark, profile, table):
    none = F.lit(None).cast("int")
    df = spark.createDataFrame([(k,) for k in table], "t string")
    got = dict(df.select("t", st.map_type(profile, F.upper("t"), none, none, none)).collect())
    assert got == table


def test_defaults(spark):
    df = spark.createDataFrame([(i, d, t) for i, (d, t, _, _) in enumerate(DEFAULTS)], "i int, d string, t string")
    my_type = F.when(F.col("t") == "boolean", "TINYINT(1)").otherwise("INT")
    out = df.select("i", st.translate_default(F.col("d"), F.col("t"), "pg"), st.translate_default(F.col("d"), my_type, "mysql"))
    assert {r[0]: (r[1], r[2]) for r in out.collect()} == {i: d[2:] for i, d in enumerate(DEFAULTS)}


def test_outer_parens(spark):
    df = spark.createDataFrame(PARENS, "x string, y string")
    assert df.where(st.strip_outer_parens(F.col("x")) != F.col("y")).collect() == []


def test_conform_values_and_audit(spark):
    df = spark.createDataFrame(
        [("12", 300, 1.005, True, "abcd", bytearray(b"\x00\x01"), "x"),
         ("oops", 40000, 1e9, None, "ab", bytearray(b"\xff\xff"), "0f8fad5b-d9cb-469f-a165-70867728950e"),
         (None, None, None, False, None, None, None)],
        "n string, t int, m double, b boolean, s string, v binary, u string")
    specs = [ColumnSpec("n", "int"), ColumnSpec("t", "tinyint"), ColumnSpec("m", "decimal", precision=6, scale=2),
             ColumnSpec("b", "bit"), ColumnSpec("s", "varchar", max_length=3), ColumnSpec("v", "rowversion"),
             ColumnSpec("u", "uniqueidentifier")]
    rows = cf.conform(df, specs, "mysql").collect()
    assert [r["n"] for r in rows] == [12, None, None]
    assert [r["t"] for r in rows] == [300, None, None]
    assert [r["m"] for r in rows] == [decimal.Decimal("1.01"), None, None]
    assert [r["b"] for r in rows] == [1, None, 0]
    assert [r["v"] for r in rows] == [1, 65535, None]
    report = {r["column_name"]: r for r in cf.audit_conformance(df, specs, "mysql").collect()}
    assert (report["n"]["failed"], report["t"]["failed"], report["t"]["out_of_range"]) == (1, 1, 1)
    assert (report["m"]["failed"], report["s"]["too_long"], report["s"]["max_chars"]) == (1, 1, 4)
    pg = {r["column_name"]: r for r in cf.audit_conformance(df, specs, "pg").collect()}
    assert pg["u"]["failed"] == 1 and pg["t"]["out_of_range"] == 0
    bad = cf.nonconforming_rows(df, specs, "mysql").select("bad_columns").collect()
    assert sorted(map(tuple, (r[0] for r in bad))) == [("n", "t", "m"), ("t", "s")]


def test_number_casts_agree_with_try_cast(spark):
    texts = ["1", " 7 ", "-0", "+5", "1.5", "1e3", "", "abc", "99999999999", "9223372036854775808", "NaN", "inf", "1d", ".5", "5.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for target in ("smallint", "int", "bigint", "double", "float", "decimal(9,2)"):
        got = df.select(cf.fit(F.col("t"), "string", target).cast("string"), F.col("t").try_cast(target).cast("string"))
        assert [r for r in got.collect() if r[0] != r[1]] == [], target
    numbers = spark.createDataFrame([(x,) for x in (1.9, -1.9, 40000.0, -32768.0, 3e9, float("nan"), 1e19, None)], "x double")
    for target in ("smallint", "int", "bigint"):
        got = numbers.select(cf.fit(F.col("x"), "double", target), F.col("x").try_cast(target))
        assert [r for r in got.collect() if r[0] != r[1]] == [], target


def test_conform_dates(spark):
    df = spark.createDataFrame([(datetime.date(2024, 5, 6), datetime.datetime(2024, 5, 6, 7, 8, 9))], "d date, t timestamp")
    row = cf.conform(df, [ColumnSpec("d", "date"), ColumnSpec("t", "datetime")], "bson").first()
    assert row["d"] == datetime.datetime(2024, 5, 6) and row["t"] == datetime.datetime(2024, 5, 6, 7, 8, 9)


def test_normalize_text(spark):
    texts = ["plain", "é", "가", "a\x00b", "Å", "é", "", None, "̈́", "x̸"]
    import unicodedata
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(df.select("i", tx.normalize_text(F.col("t"))).collect())
    assert got == {i: None if t is None else unicodedata.normalize("NFC", t.replace("\x00", "")) for i, t in enumerate(texts)}


def test_nothing_below_300_changes_under_nfc():
    import unicodedata
    low = "".join(map(chr, range(0x300)))
    assert unicodedata.normalize("NFC", low) == low


def test_quick_check_of_nfc():
    """Over all code points: text of unsuspected ones stays as it is, alone, in pairs with marks, and in any order."""
    from ferrycraft.functions.text import nfc_suspects

    suspects = set(nfc_suspects())
    safe = [chr(p) for p in range(0x110000) if p not in suspects and not 0xD800 <= p < 0xE000]
    assert all(unicodedata.is_normalized("NFC", c) for c in safe)
    rng = random.Random(1)
    for _ in range(5):
        rng.shuffle(safe)
        assert unicodedata.is_normalized("NFC", "".join(safe))
    changing = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and unicodedata.normalize("NFC", "a" + chr(p)) != "a" + chr(p)]
    assert set(changing) <= suspects and len(suspects) < 5000 and min(suspects) >= 0x300
    assert not {ord(c) for c in "Привет мир 漢字 한국어 नमस्ते العربية"} & suspects - {ord("्")}


def test_normalize_every_script(spark):
    texts = ["Привет", "漢字", "한국어", "e\u0301", "\u1100\u1161\u11a8", "\u212b", "\uf900", "\u0928\u093c", "a\x00b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tx.normalize_text(F.col("t")).alias("t"))
    want = {i: t and unicodedata.normalize("NFC", t.replace("\x00", "")) for i, t in enumerate(texts)}
    assert {r["i"]: r["t"] for r in rows.collect()} == want
