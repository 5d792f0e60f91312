"""Reporting queries and working forms of advised constructs."""

from pyspark.sql import functions as F

from ferrycraft.operators import analytics as an
from ferrycraft.operators.normalize import explode_child, json_array

from . import query, table


@query("""SELECT o.o_orderkey, o.o_orderstatus, o.o_orderdate, l.l_linenumber, l.l_partkey, p.p_name, l.l_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_custkey = 42""")
def orders_with_items(spark, d):
    out = an.orders_with_items(
        table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "part"), "o_orderkey", "l_orderkey",
        "l_partkey", "p_partkey", F.col("o_custkey") == 42, [F.desc("o_orderdate"), F.asc("l_linenumber")])
    return out.select("o_orderkey", "o_orderstatus", "o_orderdate", "l_linenumber", "l_partkey", "p_name", "l_quantity")


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_brand = 'Brand#7' AND p_retailprice < 1000")
def search_by_tag(spark, d):
    part = table(spark, d, "part")
    tagged = part.select("p_partkey", F.to_json(F.array("p_brand", "p_type")).alias("tags"))
    tags = explode_child(tagged, "p_partkey", json_array(F.col("tags")), value="tag")
    return an.search_by_tag(part.select("p_partkey", "p_name", "p_retailprice"), "p_partkey", tags, "p_partkey", "Brand#7",
                            F.col("p_retailprice") < 1000)


@query("SELECT p_partkey, p_name FROM part WHERE p_brand = 'Brand#7' AND p_retailprice < 1000")
def search_json_tags(spark, d):
    """The same search on the JSON array itself."""
    part = table(spark, d, "part").withColumn("tags", F.to_json(F.array("p_brand", "p_type")))
    return part.where(an.json_contains(F.col("tags"), "Brand#7") & (F.col("p_retailprice") < 1000)).select("p_partkey", "p_name")


@query("""SELECT user_id, count(*) AS review_count, round(avg(rating), 2) AS avg_rating
FROM (SELECT user_id, CAST(floor(value) AS INTEGER) % 5 + 1 AS rating FROM events) GROUP BY user_id""")
def group_rating(spark, d):
    events = table(spark, d, "events").select("user_id", (F.floor("value").cast("int") % 5 + 1).alias("rating"))
    return an.group_rating(events, "user_id", "rating")


@query("""SELECT p_partkey, p_name, CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,4)) AS revenue,
count(DISTINCT l_orderkey) AS order_count FROM lineitem JOIN part ON p_partkey = l_partkey
GROUP BY p_partkey, p_name ORDER BY revenue DESC, p_partkey LIMIT 10""")
def top_products(spark, d):
    return an.top_products(table(spark, d, "lineitem"), table(spark, d, "part"), "l_partkey", "l_orderkey", "l_quantity",
                           "l_extendedprice", "p_partkey", "p_name")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey, rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey
ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS INTEGER) AS rn FROM lineitem) WHERE rn <= 2""")
def lateral_top_items(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    return an.top_per_group(items, ["l_orderkey"], [
        F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_linenumber")], 2)


@query("""SELECT o_orderpriority, sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_orderstatus = 'F') AS "F",
sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_orderstatus = 'O') AS "O",
sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def pivot_status(spark, d):
    orders = table(spark, d, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    return an.pivot_sum(orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"],
                        F.sum("price").cast("decimal(38,2)"))


@query("""SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY AS added, date_diff('day', o_orderdate, TIMESTAMP '1999-01-01') AS days_between,
CAST(o_orderdate AS DATE) AS as_date FROM orders""")
def date_arithmetic(spark, d):
    out = an.date_arithmetic(table(spark, d, "orders"), "o_orderdate", 30, F.lit("1999-01-01").cast("timestamp_ntz"))
    return out.select("o_orderkey", F.col("added").cast("timestamp_ntz").alias("added"), "days_between", "as_date")


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS joined FROM events GROUP BY user_id")
def concat_per_group(spark, d):
    """The five event types are the bound on each group's list."""
    return an.concat_per_group(table(spark, d, "events"), ["user_id"], "event_type")


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END, '?') AS filled,
strftime(o_orderdate, '%d.%m.%Y') AS german, strftime(o_orderdate, '%Y%m%d') AS compact, TRY_CAST(CASE WHEN o_orderkey % 3 = 0
THEN 'x' ELSE '' || o_orderkey END AS INTEGER) AS number, true AS past FROM orders""")
def scalar_forms(spark, d):
    """ISNULL, CONVERT to text and to a number, and a comparison with GETDATE."""
    k, when = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, d, "orders").select(
        k, an.is_null(F.when(k % 4 == 0, F.col("o_orderstatus")), F.lit("?")).alias("filled"),
        an.convert(when, "string", 104).alias("german"), an.convert(when, "string", 112).alias("compact"),
        an.convert(F.when(k % 3 == 0, "x").otherwise(k.cast("string")), "int").alias("number"), an.before_now(when).alias("past"))


@query("""SELECT o_orderkey, l_linenumber, l_quantity, rn FROM orders LEFT JOIN (SELECT l_orderkey, l_linenumber, l_quantity,
CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS rn FROM lineitem
WHERE l_quantity > 30) ON l_orderkey = o_orderkey AND rn <= 2""")
def outer_top_items(spark, d):
    """OUTER APPLY: orders without a large item stay."""
    items = table(spark, d, "lineitem").where("l_quantity > 30")
    out = an.outer_top_per_group(table(spark, d, "orders"), "o_orderkey", items, "l_orderkey", [
        F.desc("l_quantity"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")], 2)
    return out.select("o_orderkey", "l_linenumber", "l_quantity", "rn")
