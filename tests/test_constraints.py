"""Audits on injected dirt, with a hot key holding a third of the rows."""

import pytest
from pyspark.sql import functions as F

from ferrycraft.operators import constraints as ct
from ferrycraft.operators import layout
from ferrycraft.operators.constraints import Constraint
from ferrycraft.operators.tried import tried_clause


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(1000).select(F.col("id").alias("o"), (F.col("id") % 7).alias("c"))


@pytest.fixture(scope="module")
def items(spark):
    """3,000 items: a third on order 5, 30 on unknown orders, 20 without an order."""
    i = F.col("id")
    key = F.when(i < 1000, 5).when(i < 1030, i + 10000).when(i < 1050, None).otherwise(i % 1000)
    return spark.range(3000).select(i.alias("line"), key.cast("bigint").alias("o"))


def test_orphans(items, orders):
    assert items.count() == 3000
    keys = ct.check_foreign_key(items, ["o"], orders)
    assert keys.count() == 30 and keys.agg(F.sum("n")).first()[0] == 30
    assert {r["line"] for r in ct.orphan_rows(items, ["o"], orders).collect()} == set(range(1000, 1030))
    assert ct.resolve_orphans(items, ["o"], orders, "delete").count() == 2970
    moved = ct.resolve_orphans(items, ["o"], orders, "reassign", reassign_to={"o": 0})
    assert moved.count() == 3000 and ct.check_foreign_key(moved, ["o"], orders).count() == 0
    assert moved.where("o is null").count() == 20
    grown = ct.resolve_orphans(items, ["o"], orders, "placeholder")
    assert grown.count() == 1030 and ct.check_foreign_key(items, ["o"], grown).count() == 0


def test_orphans_when_the_child_column_has_another_name(spark, orders):
    child = spark.createDataFrame([(1,), (5000,)], "ref bigint")
    assert [r["ref"] for r in ct.check_foreign_key(child, ["ref"], orders, ["o"]).collect()] == [5000]


def test_keys(items):
    bad = {r["o"]: (r["n"], r["problem"]) for r in ct.check_key(items, ["o"]).collect()}
    assert bad[None] == (20, "null") and bad[5] == (1001, "duplicate")
    assert None not in {r["o"] for r in ct.check_key(items, ["o"], nulls="distinct").collect()}
    assert None in {r["o"] for r in ct.check_key(items, ["o"], nulls="equal").collect()}
    assert ct.check_key(items, ["line"]).count() == 0
    assert ct.duplicate_rows(items, ["o"]).where("o = 5").count() == 1001


def test_prefix_key_is_stricter(spark):
    long = "x" * 191
    df = spark.createDataFrame([(long + "a",), (long + "b",)], "t string")
    assert ct.check_key(df, ["t"]).count() == 0
    assert ct.check_key(df, ["t"], prefix=ct.TEXT_PREFIX).first()["n"] == 2


def test_check_clauses(spark):
    df = spark.createDataFrame([(1, "ab"), (-1, "ab"), (None, "b]"), (3, None)], "`my col` int, s string")
    assert ct.check_expression(df, "(([My Col]>(0)))").count() == 1
    assert [r[1] for r in ct.check_expression(df, "[s] rlike '^[a-m]+$' or [s] = 'x''[y]'").collect()] == ["b]"]
    assert ct.check_expression(df, "[s] IS NOT NULL").count() == 1


def test_domain(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in ct.check_domain(df, "x", ["a"]).collect()] == [("b", 2)]
    assert ct.check_domain(df, "x", spark.createDataFrame([("a",), ("b",)], "y string")).count() == 0


@pytest.mark.parametrize("action,rows,nulls,defaults", [
    ("CASCADE", 3000 - 1001, 20, 0), ("SET_NULL", 3000, 1021, 0), ("SET DEFAULT", 3000, 20, 1001)])
def test_delete_actions(spark, items, action, rows, nulls, defaults):
    gone = spark.createDataFrame([(5,), (5,), (777777,)], "o bigint")
    out = ct.apply_delete(items, ["o"], gone, action, default={"o": -9})
    assert (out.count(), out.where("o is null").count(), out.where("o = -9").count()) == (rows, nulls, defaults)


def test_restrict(spark, items):
    gone = spark.createDataFrame([(5,), (777777,)], "o bigint")
    for action in ("RESTRICT", "NO ACTION"):
        assert [r["o"] for r in ct.apply_delete(items, ["o"], gone, action).collect()] == [5]


def test_report(spark, items, orders):
    rules = [
        Constraint("nn", "NOT NULL", "items", ("o",)), Constraint("ck", "CHECK", "items", clause="[o] < 10000"),
        Constraint("pk", "PRIMARY KEY", "items", ("line",)), Constraint("pk2", "PRIMARY KEY", "items", ("o",)),
        Constraint("uq", "UNIQUE", "orders", ("c",)),
        Constraint("fk", "FOREIGN KEY", "items", ("o",), ref_table="orders"),
        Constraint("fk2", "FOREIGN KEY", "orders", ("o",), ref_table="items"),
    ]
    got = {r["constraint_name"]: (r["violations"], r["status"])
           for r in ct.audit_constraints({"items": items, "orders": orders}, rules).collect()}
    distinct = items.where("o is not null").select("o").distinct().count()
    assert got["nn"] == (20, "VIOLATED") and got["ck"] == (30, "VIOLATED") and got["pk"] == (0, "VALID")
    assert got["pk2"] == (20 + 2980 - distinct, "VIOLATED") and got["uq"] == (993, "VIOLATED")
    assert got["fk"] == (30, "VIOLATED") and got["fk2"][1] == "INVALID_PARENT"


def test_foreign_key_reduces_the_child_before_the_join(items, orders):
    plan = ct.check_foreign_key(items, ["o"], orders)._jdf.queryExecution().optimizedPlan().toString()
    child, parent = plan.split("Join LeftOuter")[1].split("\n+- ")[0], plan
    assert "Aggregate" not in plan.split("Join LeftOuter")[0] and "count(1)" in child + parent.split("Join LeftOuter")[1]


def test_clustered_files_split_a_hot_key(spark, items, tmp_path):
    path = str(tmp_path / "c")
    layout.write_clustered(items, path, ["o"], partitions=6, tie_break=["line"])
    back = spark.read.parquet(path)
    assert back.count() == 3000
    hot = back.where("o = 5").select(F.input_file_name()).distinct().count()
    assert hot >= 2


def test_bucketed_join_needs_no_shuffle(spark, items, orders):
    layout.write_bucketed(items, "b_items", ["o"], 4, mode="overwrite")
    layout.write_bucketed(orders, "b_orders", ["o"], 4, mode="overwrite")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_items").join(spark.table("b_orders"), "o")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2950
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_terms(spark):
    df = spark.createDataFrame([(1, "The cat, the DOG"), (2, "Élan cat"), (3, "")], "id int, t string")
    index = layout.build_term_index(df, "id", "t")
    assert sorted(tuple(r) for r in index.collect()) == [(1, "cat"), (1, "dog"), (1, "the"), (2, "cat"), (2, "élan")]
    assert [r["id"] for r in layout.search_terms(index, "id", ["CAT", "the"]).collect()] == [1]


@pytest.mark.parametrize("clause,spark_text", [
    ("([a]>(0))", "(`a`>(0))"), ("(len([n])=(2))", "(length(`n`)=(2))"), ("(isnull([a],(0))>(1))", "(coalesce(`a`,(0))>(1))"),
    ("[n]=N'[x] len('", "`n`='[x] len('"), ("[n] like '[A-Z]_%'", "`n` RLIKE r'(?s)^[A-Z]..*$'"), ("[n] like 'a%'", "`n` like 'a%'")])
def test_clauses(clause, spark_text):
    assert ct.spark_clause(clause) == spark_text


def test_unresolved_constraints_are_skipped(spark):
    t = {"t": spark.createDataFrame([(1, "AB"), (-2, "xb")], "a int, n string")}
    rules = [ct.Constraint("bad", "CHECK", "t", clause="(isdate([n])=(1))"), ct.Constraint("no", "CHECK", "t", clause="[a]"),
             ct.Constraint("gone", "PRIMARY KEY", "u", ("a",)), ct.Constraint("col", "NOT NULL", "t", ("z",)),
             ct.Constraint("ok", "CHECK", "t", clause="[n] like '[A-Z]%'"), ct.Constraint("syntax", "CHECK", "t", clause="((")]
    out = {r["constraint_name"]: (r["status"], r["violations"], r["reason"]) for r in ct.audit_constraints(t, rules).collect()}
    assert out.pop("ok") == ("VIOLATED", 1, None)
    assert {v[:2] for v in out.values()} == {("SKIPPED", None)} and all(v[2] for v in out.values()) and len(out) == 5
    assert ct.audit_constraints(t, []).count() == 0
    assert ct.audit_constraints(t, rules[:1]).count() == 1


@pytest.mark.parametrize("clause, bad, failing", [
    ("cast([t] as int)>0", ["-1"], ["x"]), ("CAST([t] AS [int])>(0) or [t]='x'", ["-1"], []),
    ("(10/[n])>(4)", [3], [0]), ("10 % -[n] = 1", [2, -1], [0]), ("[n] between 1 and 10/[n]", [], []),
    ("bigint(t) >= 5", ["-1"], ["x"]), ("t::int <> 7", ["7"], ["x"]), ("element_at(a, n + 5) = 1", [], [0, 2, 3, 10]), ("to_date(t) > '2000-01-01'", [], ["-1", "7", "x"]),
    ("[t] = 'a/0' or (([n])+((1)/([n])))>0", [-1], [0]), ("10 / (n - 2) < 100", [], [2])])
def test_clauses_that_raise(spark, clause, bad, failing):
    """Rows that would end the job are told apart; the others are judged as if each were evaluated alone."""
    texts, numbers = ["-1", "7", "x", None], [-1, 0, 2, 3, 10, None]
    column = "t" if "t" in clause.replace("between", "").replace("element_at", "").replace("cast", "").replace("int", "") and "n" not in clause.replace("int", "").replace("between", "") else "n"
    rows = [(t, 5) for t in texts] if column == "t" else [("5", n) for n in numbers]
    df = spark.createDataFrame(rows, "t string, n int").withColumn("a", F.array(*[F.lit(i) for i in (1, 1, 9, 1)]))
    if "or" in clause and column == "n":
        df = df.withColumn("t", F.lit("b"))
    found = lambda out: sorted((r[column] for r in out.collect()), key=repr)
    assert found(ct.unevaluated_rows(df, clause)) == sorted(failing, key=repr)
    if clause not in ("10 % -[n] = 1", "element_at(a, n + 5) = 1", "(10/[n])>(4)", "[n] between 1 and 10/[n]"):
        assert found(ct.check_expression(df, clause)) == sorted(bad, key=repr)
    report = ct.audit_constraints({"x": df}, [Constraint("c", "CHECK", "x", clause=clause)]).first()
    assert report["status"] in ("VALID", "VIOLATED") and report["unevaluated"] == len(failing)


def test_one_bad_constraint_does_not_end_the_report(spark):
    items = spark.createDataFrame([(1, "x"), (2, "9"), (3, None)], "id int, `t.x` string").withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    other = spark.createDataFrame([(1,)], "key int")
    rules = [Constraint("fk", "FOREIGN KEY", "items", ("id",), ref_table="other"),
             Constraint("fk_two", "FOREIGN KEY", "items", ("id",), ref_table="other", ref_columns=("key", "key")),
             Constraint("fk_type", "FOREIGN KEY", "items", ("m",), ref_table="other", ref_columns=("key",)),
             Constraint("dm", "DOMAIN", "items", ("id",), allowed=("1", "two", None)), Constraint("dm_map", "DOMAIN", "items", ("m",), allowed=(1,)),
             Constraint("pk_map", "PRIMARY KEY", "items", ("m",)), Constraint("pk", "PRIMARY KEY", "items", ("t.x",)),
             Constraint("none", "CHECK OPTION", "items"), Constraint("nothing", "UNIQUE", "items"),
             Constraint("ck", "CHECK", "items", clause="cast([t.x] as int) > 10")]
    out = {r["constraint_name"]: (r["status"], r["violations"], r["unevaluated"]) for r in
           ct.audit_constraints({"items": items, "other": other}, rules).collect()}
    skipped = {k for k, v in out.items() if v[0] == "SKIPPED"}
    assert skipped >= {"fk", "fk_two", "fk_type", "none", "nothing"} and len(out) == len(rules)
    assert out["dm"] == ("VIOLATED", 2, 0) and out["pk"] == ("VIOLATED", 1, 0) and out["ck"] == ("VIOLATED", 1, 1)


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "`x.y` int, `t.t` string")
    parent = spark.createDataFrame([(2,)], "`x.y` int")
    assert {(r["x.y"], r["problem"]) for r in ct.check_key(df, ["x.y"]).collect()} == {(1, "duplicate"), (None, "null")}
    assert ct.duplicate_rows(df, ["x.y"]).count() == 2
    assert [tuple(r) for r in ct.check_foreign_key(df, ["x.y"], parent).collect()] == [(1, 2)]
    assert ct.orphan_rows(df, ["x.y"], parent).count() == 2
    assert ct.check_domain(df, "t.t", ["a", "b"]).count() == 1
    assert ct.apply_delete(df, ["x.y"], df.where("`x.y` = 1"), "RESTRICT").count() == 1


def test_elements_beyond_the_end(spark):
    df = spark.sql("SELECT explode(array(-1, 0, 3, 4, NULL)) AS n, array(5, 6, 7, 8) AS a")
    text, failed = tried_clause("a[n] > 5")
    assert sorted(r["n"] for r in df.where(F.expr(failed)).collect()) == [-1, 4]
    assert [r["n"] for r in df.where(F.expr(text)).collect()] == [3]


def test_repair_reads_the_child_once(spark, tmp_path):
    spark.range(600).select(F.when(F.col("id") < 200, 7).when(F.col("id") < 400, 5).otherwise(F.col("id") % 40).alias("k.k"), "id").write.parquet(f"{tmp_path}/c")
    child = spark.read.parquet(f"{tmp_path}/c").union(spark.createDataFrame([(None, 1000)], "k long, id long"))
    parent = spark.range(0, 40, 5).union(spark.range(0, 40, 5)).toDF("p")
    one = spark.read.parquet(f"{tmp_path}/c")
    for how, extra in (("delete", {}), ("reassign", {"reassign_to": {"k.k": -1}})):
        plan = ct.resolve_orphans(one, ["k.k"], parent, how, ["p"], **extra)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        out = ct.resolve_orphans(child, ["k.k"], parent, how, ["p"], **extra)
        want = [(r["k.k"], r["id"]) for r in child.collect()]
        good = lambda k: k is None or (k % 5 == 0 and 0 <= k < 40)
        want = [(k, i) for k, i in want if good(k)] if how == "delete" else [(k if good(k) else -1, i) for k, i in want]
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
