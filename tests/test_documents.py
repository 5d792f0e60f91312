"""Inference, widening and projection of documents."""

import datetime
import decimal
import itertools
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ferrycraft.functions import doc_types as dt
from ferrycraft.operators import documents as dc
from ferrycraft.operators.reconcile import fingerprint

VALUES = {
    dt.VOID: "null", dt.BOOLEAN: "true", dt.INT: "7", dt.BIGINT: "5000000000", dt.DOUBLE: "1.5",
    dt.DECIMAL: '{"$numberDecimal":"1.25"}', dt.DATETIME: '{"$date":"2024-01-02T03:04:05Z"}',
    dt.OID: '{"$oid":"507f1f77bcf86cd799439011"}', dt.JSON: "[1,2]", dt.BINARY: '{"$binary":{"base64":"aGk=","subType":"00"}}',
    dt.TEXT: '"s"',
}


def documents(spark, texts):
    return dc.parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"))


def widened(names, a, b):
    """The widening rule as the lattice states it, pair by pair."""
    numeric = [names[r] for r in (1, 2, 3, 4, 5)]
    order = {names[r]: r for r in names}
    if a == b:
        return a
    if a in numeric and b in numeric:
        return max(a, b, key=order.get)
    if names[99] in (a, b):
        return names[99]
    return max(a, b, key=order.get)


@pytest.mark.parametrize("profile", ["pg", "mysql"])
def test_widening_of_every_pair(spark, profile):
    pairs = list(itertools.product(VALUES, repeat=2))
    docs = [json.dumps({"x": 0})[:-1] + f', "p{i}": {VALUES[k]}}}' for i, pair in enumerate(pairs) for k in pair]
    names = dt.TARGET_TYPES[profile]
    got = {r["field"]: r["target_type"] for r in dc.infer_schema(documents(spark, docs), profile=profile).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[f"p{i}"] == widened(names, names[dt.RANK[a]], names[dt.RANK[b]]), (a, b)


def test_missing_is_not_null(spark):
    got = {r["field"]: (r["target_type"], r["present"]) for r in dc.infer_schema(documents(spark, [
        '{"a":1,"b":1}', '{"a":null}'])).collect()}
    assert got == {"a": ("TEXT", 2), "b": ("INTEGER", 1)}


def test_nested_wrappers_and_odd_names(spark):
    docs = documents(spark, [
        '{"_id":{"$oid":"aa"},"a":{"b":{"c":1},"e":{}},"a.b":{"x":2},"it\'s":3,"A_B":{"C":4},"d":{"$date":{"$numberLong":"1000"}},'
        '"n":{"$numberLong":"77"},"w":{"$weird":1},"bin":{"$binary":{"base64":"aGk=","subType":"00"}},"q":{"$numberDecimal":"1.10"}}'])
    rows = dc.schema_rows(dc.infer_schema(docs))
    assert [r["field"] for r in rows] == ["_id", "A_B.C", "a.b.c", "a.b.x", "bin", "d", "it's", "n", "q", "w"]
    row = dc.project_documents(docs, rows).first()
    assert row["_id"] == "aa" and row["a_b_c"] == 4 and row["a_b_c__2"] == 1 and row["a_b_x"] == 2 and row["it's"] == 3
    assert row["d"] == datetime.datetime(1970, 1, 1, 0, 0, 1) and row["n"] == 77 and bytes(row["bin"]) == b"hi"
    assert row["q"] == decimal.Decimal("1.10") and json.loads(row["w"]) == {"$weird": 1}


def test_mixed_column_audit(spark):
    docs = documents(spark, ['{"x":[1]}', '{"x":{"$binary":{"base64":"aGk=","subType":"00"}}}', '{"x":null}'])
    schema = dc.infer_schema(docs)
    assert schema.first()["target_type"] == "TEXT"
    mixed = documents(spark, ['{"x":{"$date":"2024-01-01T00:00:00Z"}}', '{"x":5}', '{"x":true}'])
    report = dc.audit_projection(mixed, dc.infer_schema(mixed)).first()
    assert (report["target_type"], report["present"], report["lost"]) == ("TIMESTAMPTZ", 3, 2)  # a number is no instant


def test_too_deep_fails(spark):
    deep = '{"a":' * 5 + "1" + "}" * 5
    assert dc.infer_schema(documents(spark, [deep]), max_depth=5).first()["field"] == "a.a.a.a.a"
    with pytest.raises(Exception, match="nested deeper than 4"):
        dc.infer_schema(documents(spark, [deep]), max_depth=4).collect()


def test_malformed_and_duplicate_keys(spark):
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":',), ('{"a":1,"a":2}',), (None,)], "value string")
    assert dc.malformed_documents(lines).count() == 2


def test_booleans_in_text_columns_follow_the_profile(spark):
    docs = documents(spark, ['{"x":true}', '{"x":null}', '{"x":"s"}'])
    for profile, expected in (("mysql", {"1", None, "s"}), ("pg", {"true", None, "s"})):
        rows = dc.project_documents(docs, dc.infer_schema(docs, profile=profile), profile).collect()
        assert {r["x"] for r in rows} == expected


def test_round_trip_keeps_the_fingerprint(spark):
    df = spark.createDataFrame(
        [(i, None if i % 3 == 0 else f"t{i}", i * 1.5, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i),
          decimal.Decimal(i) / 4, bytearray(bytes([i]))) for i in range(1, 50)],
        "id int, s string, v double, at timestamp, m decimal(38,18), raw binary")
    docs = dc.parse_documents(dc.rows_to_documents(df, "value"))
    back = dc.project_documents(docs, dc.infer_schema(docs)).select(*df.columns)
    assert back.dtypes == df.dtypes
    assert fingerprint(back).first() == fingerprint(df).first()


leaf = hs.one_of(hs.none(), hs.booleans(), hs.integers(-2**40, 2**40), hs.text("abé'", max_size=3), hs.lists(hs.integers(0, 3), max_size=2))
document = hs.dictionaries(hs.sampled_from("abc"), hs.recursive(leaf, lambda c: hs.dictionaries(
    hs.sampled_from("abc"), c, max_size=3), max_leaves=5), max_size=3)


def leaves(doc, prefix=()):
    for k, v in doc.items():
        if isinstance(v, dict):
            yield from leaves(v, (*prefix, k))
        else:
            yield (*prefix, k), v


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(document, min_size=1, max_size=6))
def test_flatten_keeps_every_leaf(spark, docs):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string")
    flat = dc.flatten_documents(dc.parse_documents(rows), keep=["i"]).select("i", "steps", F.to_json("value").alias("v"))
    got = sorted((r["i"], tuple(r["steps"]), repr(json.loads(r["v"]))) for r in flat.collect())
    assert got == sorted((i, path, repr(v)) for i, d in enumerate(docs) for path, v in leaves(d))


def test_instants_do_not_depend_on_the_zone(spark):
    rows = spark.sql("""SELECT timestamp'2020-01-01 00:00:00Z' AS t, timestamp_ntz'2020-03-08 02:30:00.5' AS n, date'2020-01-02' AS d,
        array(struct(timestamp'2020-07-01 12:00:00.25Z' AS at, 1.50BD AS m)) AS a, map('k', X'6869') AS b, double('NaN') AS x, 1.5D AS y""")
    want = None
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            text = dc.rows_to_documents(rows).first()["doc"]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        want = want or text
        assert text == want
    doc = json.loads(want)
    assert doc["t"] == {"$date": "2020-01-01T00:00:00.000000Z"} and doc["n"] == {"$date": "2020-03-08T02:30:00.500000Z"}
    assert doc["d"] == {"$date": "2020-01-02T00:00:00.000000Z"} and doc["x"] == {"$numberDouble": "NaN"} and doc["y"] == 1.5
    assert doc["a"] == [{"at": {"$date": "2020-07-01T12:00:00.250000Z"}, "m": {"$numberDecimal": "1.50"}}]
    assert doc["b"] == {"k": {"$binary": {"base64": "aGk=", "subType": "00"}}}


def test_wrapper_with_other_fields_is_an_object(spark):
    docs = documents(spark, ['{"a":{"$numberLong":"5","x":1}}', '{"a":"t"}', '{"a":{"$numberLong":"7"}}'])
    rows = dc.project_documents(docs, dc.infer_schema(docs))
    assert sorted(r[0] for r in rows.collect()) == ["7", "t", '{"$numberLong":"5","x":1}']


@pytest.mark.parametrize("text,depth", [('{"a":1}', 1), ('{"a":{"b":[{"c":1}]}}', 4), ("{}", 1), ('{"OBJECT<`x>":{"y":1}}', 2)])
def test_depth(spark, text, depth):
    assert dc.document_depth(documents(spark, [text])) == depth
    assert dc.level_bound(documents(spark, [text])) >= depth - text.count("[")
    assert dc.level_bound(documents(spark, [text]), near=0) == depth


def test_nothing_to_audit(spark):
    docs = documents(spark, ["{}"])
    assert dc.audit_projection(docs, []).count() == 0


def test_names_with_both_quotes(spark):
    """A name that no path can hold doesn't stop the collection."""
    lines = [{'it\'s "x"': {"a.b": {"'\"": 5}}, "k": 1}, {'it\'s "x"': {"a.b": {"'\"": 7}}, "k": 2}, {"k": 3}]
    docs = dc.parse_documents(spark.createDataFrame([(json.dumps(x),) for x in lines], "value string"))
    schema = dc.infer_schema(docs)
    rows = dc.project_documents(docs, schema).collect()
    name = next(c for c in rows[0].asDict() if c != "k")
    assert sorted((r["k"], r[name]) for r in rows) == [(1, 5), (2, 7), (3, None)]
    assert dc.audit_projection(docs, schema).agg(F.sum("lost")).first()[0] == 0


@pytest.mark.parametrize("limits", [(1000, 256), (1, 256), (1000, 2)])
def test_leaves_by_path_and_by_level_are_the_same(spark, monkeypatch, limits):
    """Paths that are leaves, wrappers and opened documents in turn, odd names, and collections of too many shapes or paths."""
    texts = ['{"a":1,"OBJECT":{"DECIMAL(1,2)":1.5,"select":null}}', '{"a":{"$oid":"x","b":2},"n":1.25}', '{"a":{"b":3,"c":{}},"n":10.5}',
             '{"a":{}}', '{"a":{"b":{"$x":{"y":1}}}}', '{"a":{"b":{"y":[1,{"z":2}]}}}', '{"x`y":{"é":{"":1,"it\'s \\"q\\"":2}}}', '{"$oid":{"k":1}}',
             "5", "[]", "null", "{", '{"l\\nn":{"A":1,"a":2},"1x":{"b.c":3}}', '{"DECIMAL(3,4)":1,"v":"OBJECT<"}']
    docs = dc.parse_documents(spark.createDataFrame(list(enumerate(texts)), "i int, value string"))
    shown = lambda df: sorted((r["i"], tuple(r["steps"]), r["v"]) for r in df.select("i", "steps", F.to_json("value").alias("v")).collect())
    want = shown(dc._leaves_by_level(docs, "doc", ["i"], dc.level_bound(docs)))
    monkeypatch.setattr(dc, "SHAPES", limits[0])
    monkeypatch.setattr(dc, "PATHS", limits[1])
    assert shown(dc.flatten_documents(docs, keep=["i"])) == want and len(want) == 17


def test_no_level_is_copied_on_the_way_to_a_leaf(spark):
    """Thirty levels are one path, and numbers of other precision no other shape."""
    deep = "".join('{"l%d":' % i for i in range(30))
    docs = documents(spark, [f"{deep}{10 ** i + 0.5}{'}' * 30}" for i in range(8)])
    assert len(dc.document_shapes(docs)) == 1
    plan = dc.flatten_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_entries" not in plan and "stack(1" in plan


ODD = ['{"x":1.25,"y":null,"w":{"$numberLong":"7","z":1},"n":{"$numberDouble":"1.5"}}', '{"x":null,"y":12345.5,"w":{"$oid":"aa"}}',
       '{"x":{"x":2},"w":{"b":{"$weird":1,"c":2}},"DECIMAL(3,1)":1.5,"e":{}}', '{"x":{"x":"s"},"w":{"$o":{"b":5}},"k":5000000000}',
       '{"a.b":[1.5],"c":{"$regularExpression":{"pattern":"p","options":""}},"k":1,"q`q":1.5}', "[1]", "7", "{", "{}"]


def test_shapes_tell_what_values_tell(spark):
    docs = documents(spark, ODD + list(map(json.dumps, [{"k": "5000000000"}, {"k": True}, {"x": "t", "y": 1e300}])))
    told = {tuple(r["steps"]): r for r in dc.infer_schema(docs).collect()}
    assert told == {tuple(r["steps"]): r for r in dc.infer_schema(docs, max_depth=6).collect()}
    assert len(told) > 10
    leaves = [dc.flatten_documents(docs, max_depth=n).selectExpr("steps", "to_json(value) v").collect() for n in (None, 6)]
    assert sorted(leaves[0]) == sorted(leaves[1])


def test_only_whole_numbers_are_read(spark, monkeypatch):
    """The shapes tell all other leaves, so these are not taken out of the documents."""
    read, by_path = [], dc._leaves_by_path
    monkeypatch.setattr(dc, "_leaves_by_path", lambda *a, **b: read.append(by_path(*a, **b)) or read[-1])
    docs = documents(spark, [json.dumps({"k": i, "t": "s", "a": {"f": 1.5, "on": True}, "l": [i]}) for i in range(5)])
    got = {r["field"]: (r["target_type"], r["present"]) for r in dc.infer_schema(docs).collect()}
    assert got == {"k": ("INTEGER", 5), "t": ("TEXT", 5), "a.f": ("DOUBLE PRECISION", 5), "a.on": ("BOOLEAN", 5), "l": ("JSONB", 5)}
    assert [r["steps"] for r in read[0].select("steps").distinct().collect()] == [["k"]]
