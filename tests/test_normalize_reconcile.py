"""Normal forms, surrogate keys, differences and fingerprints."""

import pytest
from pyspark.sql import functions as F

from ferrycraft.operators import analytics as an
from ferrycraft.operators import normalize as nm
from ferrycraft.operators import profiling as pf
from ferrycraft.operators import reconcile as rc
from ferrycraft.operators.documents import parse_documents


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_surrogate_keys_are_dense_and_ordered(spark, partitions):
    df = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 7919) % 1000).alias("k"), F.col("id").alias("v"))
    rows = nm.assign_surrogate_keys(df.repartition(5), ["k"], "id", start=10, partitions=partitions).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(10, 1010))
    assert [r["k"] for r in rows] == [f"k{i:05d}" for i in range(1000)]


def test_extract_entity_and_resolve(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "z"), (4, None, "z")], "id int, a string, b string")
    entity, rest = nm.extract_entity(df, ["a", "b"], "eid")
    assert entity.count() == 3 and rest.columns == ["id", "eid"]
    ids = {r["id"]: r["eid"] for r in rest.collect()}
    assert ids[1] == ids[2] and len({ids[1], ids[3], ids[4]}) == 3 and None not in ids.values()
    child = spark.createDataFrame([("y",), ("q",)], "ref string")
    got = {r["ref"]: r["eid"] for r in nm.resolve_keys(child, ["ref"], entity.where("a = 'y'"), ["a"], "eid").collect()}
    assert got["y"] == ids[3] and got["q"] is None


def test_explode_child(spark):
    docs = parse_documents(spark.createDataFrame([
        (1, '{"t":["a","b","a",null],"i":[{"q":2,"p":{"v":1.5}},{"q":"x"}]}'), (2, '{"t":[],"i":null}'), (3, '{"t":"no"}')], "id int, value string"))
    tags = nm.document_array(F.col("doc"), ["t"])
    assert [tuple(r) for r in nm.explode_child(docs, "id", tags).collect()] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, None)]
    assert sorted(tuple(r) for r in nm.explode_child(docs, "id", tags, distinct=True).collect()) == [(1, "a"), (1, "b")]
    items = nm.explode_child(docs, "id", nm.document_array(F.col("doc"), ["i"]), fields={"q": (["q"], "int"), "v": (["p", "v"], "double")})
    assert [tuple(r) for r in items.collect()] == [(1, 0, 2, 1.5), (1, 1, None, None)]
    text = spark.createDataFrame([('["a","\\"q"]',), ('{"a":1}',), ("bad",), (None,), ("[1]",)], "j string")
    assert [r[0] for r in text.select(an.json_contains(F.col("j"), '"q')).collect()][:1] == [True]


def test_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (1e12,), (None,)], "x double")
    row = nm.money_totals(df, ["x"]).first()
    assert (row["changed"], row["lost"]) == (1, 1)
    assert nm.to_decimal(df, ["x"]).where("x is null").count() == 2


def test_profiles(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("few"), F.col("id").cast("string").alias("many"),
                                  F.when(F.col("id") > 0, "x").alias("gap"))
    domains = pf.profile_domains(df, df.columns, max_values=5).collect()
    assert {(r["column_name"], r["value"]) for r in domains} == {("few", "0"), ("few", "1"), ("few", "2"), ("gap", "x")}
    profile = {r["column_name"]: r for r in pf.profile_columns(df).collect()}
    assert profile["many"]["suggested"] == "VARCHAR(4)" and not profile["gap"]["populated"] and profile["few"]["populated"]


def test_fingerprint_ignores_order_and_sees_one_cell(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 == 0, 1).alias("b"))
    base = rc.fingerprint(df).first()
    assert rc.fingerprint(df.repartition(13).orderBy(F.desc("id"))).first() == base
    assert rc.fingerprint(df.withColumn("a", F.when(F.col("id") == 77, 99).otherwise(F.col("a")))).first() != base
    swapped = df.select("id", F.col("b").cast("bigint").alias("a"), F.col("a").cast("int").alias("b"))
    assert rc.fingerprint(swapped).first()["row_hash_sum"] != base["row_hash_sum"]
    doubled = rc.fingerprint(df.union(df).union(df)).first()
    assert doubled["row_hash_sum"] == 3 * base["row_hash_sum"]


def test_observed_fingerprint(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    watched, seen = rc.observed_fingerprint(df)
    watched.write.parquet(str(tmp_path / "o"))
    assert seen.get == rc.fingerprint(spark.read.parquet(str(tmp_path / "o"))).first().asDict()


def test_diffs(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 3), ("e", 4)], "v string, k int")
    got = sorted((tuple(r) for r in rc.diff_tables(left, right).collect()), key=repr)
    assert got == [(1, "a", 1, 0), (3, "c", 1, 0), (3, "d", 0, 1), (4, "e", 0, 1)]
    by_key = {r["k"]: (r["change"], r["changed_columns"]) for r in rc.diff_by_key(left.distinct(), right, ["k"]).collect()}
    assert by_key == {3: ("changed", ["v"]), 4: ("added", None)}


def test_counts_errors_and_report(spark):
    source = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "table_name string, row_count bigint")
    target = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "table_name string, row_count bigint")
    errors = spark.createDataFrame([("c", "boom")], "table_name string, issue string")
    recon = rc.reconcile_counts(source, target, errors)
    assert {r["table_name"]: r["status"] for r in recon.collect()} == {"a": "PASS", "b": "FAIL", "c": "ERROR"}
    views = spark.createDataFrame([("v", "CREATED"), ("w", "MANUAL")], "name string, status string")
    report = rc.migration_report(recon, views).first()
    assert report["summary"].asDict() == {"total_tables": 3, "passed": 1, "failed": 2, "overall": "FAIL"}
    assert [t["table_name"] for t in report["tables"]] == ["a", "b", "c"] and report["views"]["manual"] == 1


def test_arrays(spark):
    parents = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [1])], "id int, xs array<int>")
    children = spark.createDataFrame([(1,), (1,), (3,)], "pid int")
    got = {r["parent_key"]: (r["elements"], r["child_rows"]) for r in rc.reconcile_arrays(parents, "id", "xs", children, "pid").collect()}
    assert got == {3: (0, 1), 4: (1, 0)}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50).alias("g"), "id")
    top = an.top_per_group(df, ["g"], [F.desc("id")], 2)
    assert top.where("g = 0").count() == 2
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_fingerprint_takes_every_type(spark):
    rows = spark.sql("""SELECT map('b', 1, 'a', 2) AS m, struct(map('x', array(1)) AS n) AS s, parse_json('{"q":1}') AS v, X'00' AS b,
        CAST(NULL AS array<int>) AS a""")
    turned = spark.sql("""SELECT map('a', 2, 'b', 1) AS m, struct(map('x', array(1)) AS n) AS s, parse_json('{"q":1}') AS v, X'00' AS b,
        CAST(NULL AS array<int>) AS a""")
    assert rc.fingerprint(rows).first() == rc.fingerprint(turned).first()
    assert rc.fingerprint(rows.drop("v")).first()[1] != rc.fingerprint(rows).first()[1]


def test_kept_surrogate_keys(spark, tmp_path):
    path = f"{tmp_path}/keys"
    rows = lambda *r: spark.createDataFrame(list(r), "`a.a` string, b int")
    number = lambda df, batch: {(r["a.a"], r["b"]): r["id"] for r in nm.extend_surrogate_keys(df, ["a.a", "b"], path, batch).collect()}
    one = number(rows(("x", 1), ("x", 1), ("y", 2), ("z", None)), 0)
    assert one == {("x", 1): 1, ("y", 2): 2, ("z", None): None}
    two = number(rows(("a", 1), ("y", 2), ("b", 0)), 1)
    assert two == {("a", 1): 3, ("b", 0): 4, ("y", 2): 2}
    assert number(rows(("a", 1), ("y", 2), ("b", 0)), 1) == two  # a batch that is run again
    assert number(rows(("a", 1)), 2) == {("a", 1): 3}
    assert number(rows(("c", 1), ("x", 1)), 3) == {("c", 1): 5, ("x", 1): 1}
    with pytest.raises(ValueError):
        number(rows(("q", 1)), 1)
    held = [r["id"] for r in nm.key_dictionary(spark, path).collect()]
    assert sorted(held) == [1, 2, 3, 4, 5]
