"""Diffs through hash trees, exact totals, merged sketches."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from ferrycraft.operators import hash_tree as ht
from ferrycraft.operators import normalize as nm
from ferrycraft.operators import reconcile as rc

D = decimal.Decimal


def tables(spark, kind, n=400):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", None, "b"]), i / 3) for i in rng.sample(range(-5000, 5000), n)]
    right = [(k, v, x + 1 if k % 41 == 0 else x) for k, v, x in left if k % 37 != 5]
    right = [(k, None if k % 53 == 0 else v, x) for k, v, x in right] + [(9999, "new", None), (None, "null key", 1.0)]
    key = {"long": F.col("k"), "date": F.date_add(F.lit("2000-01-01").cast("date"), F.col("k").cast("int")),
           "timestamp": F.timestamp_seconds(F.col("k") * 1000), "string": F.col("k").cast("string"),
           "decimal": F.col("k").cast("decimal(30,2)"), "wide": F.col("k") * 900000000000000}[kind]
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string, x double").select(
        key.alias("the.key"), F.col("v").alias("v.1"), "x").repartition(3)
    return frame(left), frame(right)


def plain(left, right):
    name = lambda v: None if v is None else (str(v) if not isinstance(v, float) else repr(v))
    l, r = ({row[0]: row for row in df.collect()} for df in (left, right))
    out = []
    for k in l.keys() | r.keys():
        if k not in r:
            out.append((k, "removed", None, None, None))
        elif k not in l:
            out.append((k, "added", None, None, None))
        else:
            out += [(k, "changed", c, name(a), name(b)) for c, a, b in zip(("the.key", "v.1", "x"), l[k], r[k]) if a != b]
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["long", "date", "timestamp", "string", "decimal", "wide"])
def test_cells(spark, kind):
    left, right = tables(spark, kind)
    found = ht.tree_diff(left, right, ["the.key"], fanout=4, leaf_rows=16)
    told = [tuple(r) for r in found.cells.collect()]
    want = plain(left, right)
    number = lambda rows: [(k, c, col, *(float(x) if x is not None and col == "x" else x for x in (a, b))) for k, c, col, a, b in rows]
    assert sorted(number(told), key=repr) == number(want)
    levels = found.levels.orderBy("level").collect()
    assert len(levels) == 3 and levels[0]["rows_read"] == left.count() + right.count()
    assert all(a["part_width"] > b["part_width"] for a, b in zip(levels, levels[1:]))


def test_only_differing_ranges_are_read(spark, tmp_path):
    left = spark.range(20000).select("id", (F.col("id") * 7).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 12345, -1).otherwise(F.col("v")))
    for name, df in (("l", left), ("r", right)):
        df.repartitionByRange(10, "id").write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in "lr")
    found = ht.tree_diff(left, right, ["id"], fanout=8, leaf_rows=40)
    assert [tuple(r) for r in found.cells.collect()] == [(12345, "changed", "v", "86415", "-1")]
    read = [r["rows_read"] for r in found.levels.orderBy("level").collect()]
    assert read[0] == 40000 and read[1] < 10000 and read[2] < 1000
    plan = found.cells._jdf.queryExecution().executedPlan().toString()
    assert "Parquet" in plan


def test_equal_and_empty_tables(spark):
    left, _ = tables(spark, "long")
    same = ht.tree_diff(left, left, ["the.key"], leaf_rows=10)
    assert same.cells.count() == 0 and same.levels.count() == 1
    none = left.limit(0)
    assert ht.tree_diff(none, none, ["the.key"]).cells.count() == 0
    assert ht.tree_diff(none, left, ["the.key"], leaf_rows=10).cells.where("change = 'added'").count() == left.count()


def test_repeated_keys_and_columns_that_trade_nulls(spark):
    left = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, "b", None), (2, None, "x")], "k int, p string, q string")
    right = spark.createDataFrame([(1, "a", None), (1, "b", None), (1, "c", None), (2, "x", None)], "k long, p string, q string")
    cells = sorted(tuple(r) for r in ht.tree_diff(left, right, ["k"]).cells.fillna("-").collect())
    assert cells == [(1, "changed", "p", "a", "c"), (2, "changed", "p", "-", "x"), (2, "changed", "q", "x", "-")]


@pytest.mark.parametrize("kind, values", [
    ("decimal(38,0)", [10 ** 37, 10 ** 37, 9 * 10 ** 37, -1, 9 * 10 ** 37, 9 * 10 ** 37]),
    ("decimal(38,0)", [-9 * 10 ** 37] * 3 + [1]),
    ("decimal(38,5)", [D("1000000000000000000000000000001"), D("0.00001"), D("0.00001"), None]),
    ("decimal(38,36)", [D("1e-36"), D("-99"), D("98.999999999999999999999999999999999999")]),
    ("decimal(10,2)", [D("-0.01"), D("-0.99"), D("1.00")]),
    ("decimal(10,2)", [D("-0.01")]), ("bigint", [2 ** 63 - 1] * 3), ("bigint", [-2 ** 63] * 2 + [5]), ("tinyint", [1, -1]),
    ("decimal(5,5)", [D("0.99999")] * 3)])
def test_exact_sums(spark, kind, values):
    df = spark.createDataFrame([(v if v is None else D(v),) for v in values], "x decimal(38,36)" if "36)" in kind else (
        f"x {kind}" if "decimal" in kind else "x decimal(38,0)")).select(F.col("x").cast(kind).alias("the.x"))
    row = rc.column_totals(df).first()
    with decimal.localcontext() as exact:
        exact.prec = 90
        total = sum((D(v) for v in values if v is not None), D(0))
    assert D(row["exact_sum"]) == total and row["unsummed"] == 0 and "E" not in row["exact_sum"]
    assert row["exact_sum"].startswith("-") == (total < 0)


def test_floating_point_sums(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1e-5,), (float("nan"),), (float("inf"),), (1e300,), (None,)], "x double")
    row = rc.column_totals(df).first()
    assert row["exact_sum"] == "0.300010000000000000" and row["unsummed"] == 3 and row["nulls"] == 1
    empty = rc.column_totals(df.where("x IS NULL")).first()
    assert empty["exact_sum"] is None and empty["unsummed"] == 0 and empty["total_rows"] == 1


def test_money(spark):
    df = spark.createDataFrame([(D("1000000000000000000000000000001.00001"),), (D("1.005"),)], "x decimal(38,5)")
    row = nm.money_totals(df, ["x"]).first()
    assert row["sum_before"] == "1000000000000000000000000000002.00501" and row["sum_after"] == "1.01"
    assert row["lost"] == 1 and row["changed"] == 1 and row["unsummed"] == 0


def test_sketches_merge(spark):
    df = spark.range(60000).select((F.col("id") % 20000).alias("a"), F.array("id").alias("b"), F.lit(None).cast("string").alias("c"),
                                   F.lit(datetime.date(2020, 1, 1)).alias("d"))
    kept = rc.distinct_sketches(df.where("id < 30000")).union(rc.distinct_sketches(df.where("id >= 30000")))
    found = {r["column_name"]: r for r in rc.merged_distinct(kept).collect()}
    assert abs(found["a"]["distinct_estimate"] - 20000) < 600 and abs(found["b"]["distinct_estimate"] - 60000) < 1800
    assert found["c"]["distinct_estimate"] == 0 and found["d"]["distinct_estimate"] == 1 and found["a"]["rows"] == 60000


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "decimal(38,18)", "decimal(20,0)", "decimal(18,18)"])
def test_sums_of_short_numbers_split_no_digits(spark, kind):
    """Numbers that leave room are summed as they are, with the same digits, also far from zero on either side."""
    whole = 0 if kind == "decimal(18,18)" else 99999 if kind == "double" else 10 ** 9
    values = [D(w) + D(f) / 8 for w in (whole, -whole, whole // 7, 0) for f in ((0,) if kind == "decimal(20,0)" else (1, -3, 5))] * 3
    cut = 2 if kind == "decimal(12,2)" else 3
    values = [round(v, cut) for v in values] + [None]
    df = spark.createDataFrame([(None if v is None else str(v),) for v in values], "x string").select(F.col("x").cast(kind))
    total = df.agg(rc.exact_sum(F.col("x"), df.schema["x"].dataType)[0].alias("s"))
    assert D(total.first()["s"]) == sum(v for v in values if v is not None)
    plan = total._jdf.queryExecution().analyzed().toString()
    assert "rpad" not in plan[plan.rindex("Aggregate"):] if "Aggregate" in plan else False
