"""Reconciliation of source and target."""

from functools import reduce

from pyspark.sql import functions as F

from ferrycraft.operators import hash_tree
from ferrycraft.operators import reconcile as rc
from ferrycraft.operators.documents import parse_documents
from ferrycraft.operators.normalize import document_array, explode_child

from ferrycraft.session import spread, stage

from . import query, table
from .inputs import order_documents

_RECON = """SELECT t AS table_name, s AS source_rows, g AS target_rows, CAST(NULL AS VARCHAR) AS issue, s = g AS matches,
CASE WHEN s = g THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'orders' AS t, count(*) AS s, count(*) FILTER (o_orderkey % 5 <> 0) AS g FROM orders
UNION ALL SELECT 'customer', count(*), count(*) FROM customer UNION ALL SELECT 'part', count(*), -1 FROM part
UNION ALL SELECT 'nation', -1, count(*) FROM nation)"""


def _recon(spark, d):
    """A target that lost some orders and the parts, and has a table the source lacks."""
    tables = {n: table(spark, d, n) for n in ("orders", "customer", "part", "nation")}
    source = rc.table_counts({n: t for n, t in tables.items() if n != "nation"})
    target = rc.table_counts({n: (t.where(F.col("o_orderkey") % 5 != 0) if n == "orders" else t)
                              for n, t in tables.items() if n != "part"})
    return rc.reconcile_counts(source, target)


@query(_RECON)
def reconcile_counts(spark, d):
    return _recon(spark, d)


@query(f"""SELECT count(*) AS total_tables, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status <> 'PASS') AS failed,
CASE WHEN count(*) FILTER (status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall FROM ({_RECON})""")
def load_summary(spark, d):
    return rc.load_summary(_recon(spark, d))


@query(f"""SELECT 4::BIGINT AS total_tables, count_if(status = 'PASS') AS passed, count_if(status <> 'PASS') AS failed, 'FAIL' AS overall,
string_agg(table_name || ':' || s || ':' || g || ':' || matches || ':' || status || ':-', ',' ORDER BY table_name) AS tables
FROM (SELECT *, source_rows AS s, target_rows AS g FROM ({_RECON}))""")
def migration_report(spark, d):
    """The whole report but the time it was made."""
    entry = lambda t: F.concat_ws(":", t["table_name"], t["source_rows"], t["target_rows"], t["matches"], t["status"],
                                  F.coalesce(t["issue"], F.lit("-")))
    return rc.migration_report(_recon(spark, d)).select(
        "summary.*", F.array_join(F.transform("tables", entry), ",").alias("tables"))


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]
_TEXT = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in _LINE)


@query(f"""SELECT count(*) AS rows, CAST(sum(CAST(('0x' || left(md5({_TEXT}), 15)) AS BIGINT)) AS DECIMAL(38,0)) AS row_hash_sum,
{", ".join(f"count(*) FILTER ({c} IS NULL) AS nulls__{c}" for c in _LINE)} FROM (SELECT * REPLACE (
CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS l_returnflag) FROM lineitem)""")
def fingerprint(spark, d):
    """Content of a table whatever its row order, by a hash that both engines have."""
    lines = spread(table(spark, d, "lineitem").select(_LINE))
    return rc.fingerprint(lines.withColumn("l_returnflag", F.when(F.col("l_linenumber") != 3, F.col("l_returnflag"))))


_ORDER_TOTALS = """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS o_totalprice, o_orderstatus,
(CASE WHEN o_orderkey % 1009 = 0 THEN '1000000000000000000000000000001.00000' WHEN o_orderkey % 3 = 1 THEN '0.00001' ELSE '-0.00003' END)::DECIMAL(38,5) AS wide FROM orders"""


def _exact(column, kind):
    return f"CAST(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL({kind}))) AS VARCHAR)"


@query(f"""SELECT 'o_orderkey' AS column_name, count(*) AS total_rows, 0::BIGINT AS nulls, {_exact('o_orderkey', '38,0')} AS exact_sum,
0::BIGINT AS unsummed, true AS distinct_close, min(o_orderkey)::VARCHAR AS smallest, max(o_orderkey)::VARCHAR AS largest FROM ({_ORDER_TOTALS})
UNION ALL SELECT 'o_totalprice', count(*), count_if(o_totalprice IS NULL), {_exact('o_totalprice', '38,18')}, 0, true,
min(o_totalprice)::DECIMAL(38,2)::VARCHAR, max(o_totalprice)::DECIMAL(38,2)::VARCHAR FROM ({_ORDER_TOTALS})
UNION ALL SELECT 'o_orderstatus', count(*), 0, NULL, 0, true, min(o_orderstatus), max(o_orderstatus) FROM ({_ORDER_TOTALS})
UNION ALL SELECT 'wide', count(*), 0, {_exact('wide', '38,5')}, 0, true, min(wide)::VARCHAR, max(wide)::VARCHAR FROM ({_ORDER_TOTALS})""")
def column_totals(spark, d):
    """Sums to the last digit, 31-digit and tiny values among them; estimates within five percent of the exact counts."""
    k = F.col("o_orderkey")
    wide = F.when(k % 1009 == 0, "1000000000000000000000000000001.00000").when(k % 3 == 1, "0.00001").otherwise("-0.00003")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.when(k % 9 != 0, F.col("o_totalprice")).alias("o_totalprice"), "o_orderstatus",
        wide.cast("decimal(38,5)").alias("wide"))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "column_name", "n")
    totals = rc.column_totals(orders).join(exact, "column_name")
    plain = lambda c: F.when(F.col("column_name") == "o_totalprice", F.col(c).cast("double").cast("decimal(38,2)")
                             .cast("string")).otherwise(F.col(c)).alias(c)  # large doubles print with an exponent
    close = F.abs(F.col("distinct_estimate") / F.col("n") - 1) < 0.05
    return totals.select("column_name", "total_rows", "nulls", "exact_sum", "unsummed", close.alias("distinct_close"),
                         plain("smallest"), plain("largest"))


@query("""SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderdate', 'o_orderstatus']) AS column_name, n AS rows, true AS close
FROM (SELECT count(*) AS n FROM orders)""")
def merged_distinct(spark, d):
    """Distinct counts from the sketches of five batches, within five percent of the exact counts over everything."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    parts = [rc.distinct_sketches(orders.where(F.col("o_orderkey") % 5 == i)) for i in range(5)]
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "column_name", "n")
    merged = rc.merged_distinct(reduce(lambda a, b: a.unionByName(b), parts)).join(exact, "column_name")
    return merged.select("column_name", "rows", (F.abs(F.col("distinct_estimate") / F.col("n") - 1) < 0.05).alias("close"))


def _order_copies(spark, d):
    """Orders and a copy that lost some rows of one key range, changed cells in it and gained rows behind it."""
    left = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    own = (k >= 3000) & (k < 3200)
    right = left.where(~(own & (k % 40 == 3))).withColumns({
        "o_orderstatus": F.when(own & (k % 50 == 4), "X").otherwise(F.col("o_orderstatus")),
        "o_totalprice": F.when(own & (k % 100 == 4), -1.0).otherwise(F.col("o_totalprice"))})
    return left, right.unionByName(left.where(k.isin(7, 8)).withColumn("o_orderkey", k + 900000000))


_LOST = "o_orderkey BETWEEN 3000 AND 3199 AND o_orderkey % 40 = 3"


@query(f"""SELECT o_orderkey, 'removed' AS change, NULL AS column_name, NULL AS left_value, NULL AS right_value FROM orders WHERE {_LOST}
UNION ALL SELECT o_orderkey + 900000000, 'added', NULL, NULL, NULL FROM orders WHERE o_orderkey IN (7, 8)
UNION ALL SELECT o_orderkey, 'changed', 'o_orderstatus', o_orderstatus, 'X' FROM orders
WHERE o_orderkey BETWEEN 3000 AND 3199 AND o_orderkey % 50 = 4 AND NOT ({_LOST})
UNION ALL SELECT o_orderkey, 'changed', 'o_totalprice', CAST(o_totalprice AS VARCHAR), '-1.0' FROM orders
WHERE o_orderkey BETWEEN 3000 AND 3199 AND o_orderkey % 100 = 4 AND NOT ({_LOST})""")
def tree_diff_cells(spark, d):
    """Changed cells, found by opening only key ranges whose hashes differ."""
    return hash_tree.tree_diff(*_order_copies(spark, d), ["o_orderkey"], fanout=8, leaf_rows=64).cells


# Every level from the formulas of the tree: a part is read when its range differs on the level above.
@query(f"""WITH l AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders),
r AS (SELECT k, CASE WHEN k BETWEEN 3000 AND 3199 AND k % 50 = 4 THEN 'X' ELSE s END AS s,
  CASE WHEN k BETWEEN 3000 AND 3199 AND k % 100 = 4 THEN -1.0 ELSE p END AS p FROM l WHERE NOT (k BETWEEN 3000 AND 3199 AND k % 40 = 3)
  UNION ALL SELECT k + 900000000, s, p FROM l WHERE k IN (7, 8)),
shape AS (SELECT min(k) AS low, max(k) AS high, greatest((SELECT count(*) FROM l), (SELECT count(*) FROM r)) AS n
  FROM (SELECT k FROM l UNION ALL SELECT k FROM r)),
leaf AS (SELECT low, high - low + 1 AS span, (n + 63) // 64 AS leaves, (high - low + (n + 63) // 64) // ((n + 63) // 64) AS w FROM shape),
levels AS (SELECT i AS level, low, CAST(least(w * pow(8, depth - 1 - i), span) AS BIGINT) AS width, CAST(least(w * pow(8, depth - i), span) AS BIGINT) AS above
  FROM (SELECT *, (SELECT min(x) FROM range(1, 30) t(x) WHERE pow(8, x) >= leaves) AS depth FROM leaf), range(0, depth) t(i)),
net AS (SELECT k, s, p, sum(sign) AS net, count(*) AS n FROM (SELECT *, 1 AS sign FROM l UNION ALL SELECT *, -1 FROM r) GROUP BY ALL),
parts AS (SELECT level, width, (k - low) // width AS part, (k - low) // above AS up, sum(n) AS rows, bool_or(net <> 0) AS differs
  FROM net, levels GROUP BY ALL),
opened AS (SELECT DISTINCT level + 1 AS level, part AS up FROM parts WHERE differs)
SELECT CAST(level AS INTEGER) AS level, width AS part_width, count(*) AS parts, count_if(differs) AS differing,
  CAST(sum(rows) AS BIGINT) AS rows_read FROM parts WHERE level = 0 OR (level, up) IN (SELECT (level, up) FROM opened) GROUP BY ALL""")
def tree_diff_levels(spark, d):
    """Rows read on each level of the tree."""
    return hash_tree.tree_diff(*_order_copies(spark, d), ["o_orderkey"], fanout=8, leaf_rows=64).levels


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(1 AS BIGINT) AS left_extra, CAST(0 AS BIGINT) AS right_extra
FROM orders WHERE o_orderkey % 100 IN (3, 4) UNION ALL
SELECT o_orderkey, 'X', o_totalprice, 0, 1 FROM orders WHERE o_orderkey % 100 = 4""")
def diff_tables(spark, d):
    """A copy that lost some rows and changed a cell in others."""
    left = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey") % 100
    right = left.where(k != 3).withColumn("o_orderstatus", F.when(k == 4, "X").otherwise(F.col("o_orderstatus")))
    return rc.diff_tables(left, right)


@query("""SELECT o_orderkey, CASE o_orderkey % 100 WHEN 3 THEN 'removed' ELSE 'changed' END AS change,
CASE WHEN o_orderkey % 100 = 4 THEN 'o_orderstatus' END AS changed_columns FROM orders WHERE o_orderkey % 100 IN (3, 4)
UNION ALL SELECT -o_orderkey - 1, 'added', NULL FROM orders WHERE o_orderkey % 1000 = 1""")
def diff_by_key(spark, d):
    left = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey") % 100
    right = left.where(k != 3).withColumn("o_orderstatus", F.when(k == 4, "X").otherwise(F.col("o_orderstatus")))
    added = left.where(F.col("o_orderkey") % 1000 == 1).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    diff = rc.diff_by_key(left, right.unionByName(added), ["o_orderkey"])
    return diff.withColumn("changed_columns", F.array_join("changed_columns", ","))


@query("""WITH n AS (SELECT l_orderkey AS k, count(*) AS c FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1)
SELECT k AS parent_key, c AS elements, c - 1 AS child_rows FROM n WHERE k % 50 = 3
UNION ALL SELECT -1, 0, count(*) FROM n WHERE k % 50 = 4 HAVING count(*) > 0""")
def reconcile_arrays(spark, d):
    """Items exploded to a child table that lost some rows and has rows of an unknown parent."""
    docs = stage(parse_documents(order_documents(spark, d)).select("o_orderkey", document_array(
        F.col("doc"), ["items"]).alias("items")), "order-items")
    children = explode_child(docs, "o_orderkey", F.col("items"), fields={"qty": (["qty"], "int")})
    k = F.col("o_orderkey") % 50
    lost = children.where(~((k == 3) & (F.col("pos") == 0)))
    moved = lost.unionByName(lost.where((k == 4) & (F.col("pos") == 0)).withColumn("o_orderkey", F.lit(-1).cast("bigint")))
    return rc.reconcile_arrays(docs, "o_orderkey", "items", moved, "o_orderkey")
