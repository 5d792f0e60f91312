"""Inputs that the tables do not hold directly, derived from them row by row (Spark side and SQL side).

``part`` stands in for a source dictionary: each part is a table with one to seven columns.
"""

from pyspark.sql import functions as F

from ferrycraft.functions.sql_types import BSON_TYPES
from ferrycraft.session import spread

from . import table

TYPES = sorted(set(BSON_TYPES) | {"mystery"})
LENGTHS = [-1, 16, 255, 256, 16383, 16384, None]
PRECISIONS = [None, 12, 24, 53]
SCALES = [None, 2, 0]


def sql_literal(value):
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    return str(value)


def _sql_list(values):
    return "[" + ", ".join(sql_literal(v) for v in values) + "]"


# Default expression of each form; {size}, {type} and {brand} come from the row.
DEFAULTS = [
    None, "(({size}))", "(N'{type}')", "('{brand}')", "(getdate())", "(sysutcdatetime())", "(newid())", "(NULL)",
    "(N'')", "((1))", "((0))", "(1)+(2)", "CONVERT([bit],(0))", "(-1.5e3)", "( ( 7 ) )", "(sysdatetimeoffset())",
]


def _sql_default(form):
    if form is None:
        return "NULL"
    text = form.replace("'", "''")
    for slot, column in (("size", "p_size"), ("type", "p_type"), ("brand", "p_brand")):
        text = text.replace("{%s}" % slot, f"' || {column} || '")
    return f"'{text}'"


def _spark_default(form):
    if form is None:
        return F.lit(None).cast("string")
    for slot, column in (("size", "p_size"), ("type", "p_type"), ("brand", "p_brand")):
        before, found, after = form.partition("{%s}" % slot)
        if found:
            return F.concat(F.lit(before), F.col(column).cast("string"), F.lit(after))
    return F.lit(form)


DICT_COLUMNS_SQL = f"""(SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name, 'Col' || o AS column_name,
 CAST(o AS INTEGER) AS ordinal_position, list_extract({_sql_list(TYPES)}, (p_partkey * 3 + o) % {len(TYPES)} + 1) AS data_type,
 CAST(list_extract({_sql_list(LENGTHS)}, (p_partkey + o) % {len(LENGTHS)} + 1) AS INTEGER) AS character_maximum_length,
 CAST(list_extract({_sql_list(PRECISIONS)}, (p_partkey + 2 * o) % {len(PRECISIONS)} + 1) AS INTEGER) AS numeric_precision,
 CAST(list_extract({_sql_list(SCALES)}, (p_partkey + o) % {len(SCALES)} + 1) AS INTEGER) AS numeric_scale,
 CASE WHEN (p_partkey + o) % 3 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
 (p_partkey + o) % {len(DEFAULTS)} AS form,
 CASE (p_partkey + o) % {len(DEFAULTS)} {' '.join(f"WHEN {i} THEN {_sql_default(f)}" for i, f in enumerate(DEFAULTS))} END AS column_default,
 CASE WHEN o = 1 AND p_partkey % 4 = 0 THEN 1 ELSE 0 END AS is_identity, p_partkey, p_size, p_type, p_brand
 FROM (SELECT *, unnest(range(1, 2 + p_partkey % 7)) AS o FROM part))"""


def dict_columns(spark, d):
    pick = lambda values, index, t: F.element_at(
        F.array(*[F.lit(v).cast(t) for v in values]), (index % len(values) + 1).cast("int"))
    p, o = F.col("p_partkey"), F.col("o")
    form = (p + o) % len(DEFAULTS)
    default = F.lit(None).cast("string")
    for i, f in enumerate(DEFAULTS):
        default = F.when(form == i, _spark_default(f)).otherwise(default)
    parts = spread(table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_type"))
    rows = parts.withColumn("o", F.explode(F.sequence(F.lit(1), (F.col("p_partkey") % 7 + 1).cast("int"))))
    return rows.select(
        F.upper("p_brand").alias("table_schema"), F.concat(F.lit("T"), "p_partkey").alias("table_name"),
        F.concat(F.lit("Col"), "o").alias("column_name"), F.col("o").alias("ordinal_position"),
        pick(TYPES, p * 3 + o, "string").alias("data_type"),
        pick(LENGTHS, p + o, "int").alias("character_maximum_length"),
        pick(PRECISIONS, p + 2 * o, "int").alias("numeric_precision"), pick(SCALES, p + o, "int").alias("numeric_scale"),
        F.when((p + o) % 3 == 0, "YES").otherwise("NO").alias("is_nullable"), default.alias("column_default"),
        F.when((o == 1) & (p % 4 == 0), 1).otherwise(0).alias("is_identity"))


DICT_TABLES_SQL = """(SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name,
 CASE WHEN p_size % 5 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type FROM part)"""


def dict_tables(spark, d):
    return table(spark, d, "part").select(
        F.upper("p_brand").alias("table_schema"), F.concat(F.lit("T"), "p_partkey").alias("table_name"),
        F.when(F.col("p_size") % 5 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"))


def dict_constraints(spark, d):
    """A primary key and a unique constraint per table."""
    kinds = F.explode(F.array(F.lit("PRIMARY KEY"), F.lit("UNIQUE"))).alias("constraint_type")
    return table(spark, d, "part").select("p_brand", "p_partkey", kinds).select(
        F.concat(F.when(F.col("constraint_type") == "UNIQUE", "UQ_T").otherwise("PK_T"), "p_partkey").alias("constraint_name"),
        F.upper("p_brand").alias("table_schema"), F.concat(F.lit("T"), "p_partkey").alias("table_name"), "constraint_type")


def dict_key_usage(spark, d):
    """Primary keys use one to three columns, in an order unlike their names; unique constraints two."""
    part = table(spark, d, "part").select("p_brand", "p_partkey")
    row = lambda name, o, column: (
        F.concat(F.lit(name), "p_partkey").alias("constraint_name"), F.upper("p_brand").alias("table_schema"),
        F.concat(F.lit("Col"), column).alias("column_name"), o.cast("int").alias("ordinal_position"))
    width = (F.col("p_partkey") % 3 + 1).cast("int")
    pk = part.withColumn("o", F.explode(F.sequence(F.lit(1), width))).select(*row("PK_T", F.col("o"), width - F.col("o") + 1))
    uq = part.withColumn("o", F.explode(F.array(F.lit(1), F.lit(2)))).select(*row("UQ_T", F.col("o"), F.col("o") + 3))
    return pk.unionByName(uq)


ACTIONS = ["CASCADE", "NO_ACTION", "SET_NULL", "SET_DEFAULT", None]


def dict_fk_columns(spark, d):
    """One foreign key per table, of one or two columns; every fifth refers to schema DBO."""
    p = F.col("p_partkey")
    action = lambda shift: F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), ((p + shift) % 5 + 1).cast("int"))
    return table(spark, d, "part").withColumn("o", F.explode(F.sequence(F.lit(1), (p % 2 + 1).cast("int")))).select(
        F.concat(F.lit("FK_T"), p).alias("fk_name"), F.upper("p_brand").alias("table_schema"),
        F.concat(F.lit("T"), p).alias("table_name"), F.concat(F.lit("Col"), "o").alias("column_name"),
        F.col("o").alias("ordinal_position"), F.when(p % 5 == 0, "DBO").otherwise(F.upper("p_brand")).alias("ref_schema"),
        F.concat(F.lit("T"), F.floor(p / 2)).alias("ref_table"), F.concat(F.lit("Key"), "o").alias("ref_column"),
        action(0).alias("on_delete"), action(1).alias("on_update"))


def dict_indexes(spark, d):
    p = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.upper("p_brand").alias("table_schema"), F.concat(F.lit("T"), p).alias("table_name"),
        F.when(p % 11 != 0, F.concat(F.lit("IX_T"), p)).alias("index_name"), (p % 2).cast("int").alias("is_unique"),
        F.when(p % 4 == 0, 1).otherwise(0).alias("is_primary_key"),
        F.when(p % 6 == 1, 1).otherwise(0).alias("is_unique_constraint"))


def dict_index_columns(spark, d):
    """Three columns per index: two keys in reverse order and one INCLUDE column with ordinal 0."""
    p, o = F.col("p_partkey"), F.col("o")
    return table(spark, d, "part").withColumn("o", F.explode(F.array(*[F.lit(i) for i in range(3)]))).select(
        F.upper("p_brand").alias("table_schema"), F.concat(F.lit("T"), p).alias("table_name"),
        F.concat(F.lit("IX_T"), p).alias("index_name"), F.concat(F.lit("Col"), 3 - o).alias("column_name"),
        o.alias("key_ordinal"))


# Text put behind each document so that every rule has a hit, and near misses that must not count.
SNIPPETS = [
    "EXEC (@q)", "EXECUTE sp", "INTO #tmp", "# tmp", "from OpenRowSet(x)", "OPENROWSETS", "FOR  XML PATH", "FORXML",
    "select TOP 10 a", "TOP ten", "IsNull (a, 0)", "IS NULL (a)", "@@RowCount > 0", "ROWCOUNT", "raiserror('x')",
    "RAISERRORS", "WITH (NOLOCK)", "NOLOCKS", "dateadd(day, 1, x)", "DATE ADD(", "DATEDIFF (day, a, b)", "DATEDIFFS (",
    "CONVERT(int, x)", "CONVERTED (", "getdate()", "getdate(1)", "nvarchar(10)", "NVARCHAR2", "a CROSS APPLY f(x)",
    "CROSSAPPLY", "b outer\n apply g(x)", "OUTER APPLIED", "PIVOT (sum(x)", "PIVOTED", "", "plain",
]
DEFINITIONS_SQL = f"""(SELECT source || '.d' || doc_id AS object,
 list_extract(['VIEW', 'FUNCTION', 'PROCEDURE'], doc_id % 3 + 1) AS object_type, source AS schema, 'd' || doc_id AS name,
 CASE WHEN doc_id % 97 = 5 THEN '' ELSE text || chr(10) ||
 list_extract({_sql_list(SNIPPETS)}, doc_id % {len(SNIPPETS)} + 1) END AS definition FROM documents)"""


def definitions(spark, d):
    doc_id = F.col("doc_id")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (doc_id % len(values) + 1).cast("int"))
    text = F.concat(F.col("text"), F.lit("\n"), pick(SNIPPETS))
    return spread(table(spark, d, "documents").select("doc_id", "source", "text")).select(
        F.concat(F.col("source"), F.lit(".d"), doc_id).alias("object"),
        pick(["VIEW", "FUNCTION", "PROCEDURE"]).alias("object_type"), F.col("source").alias("schema"),
        F.concat(F.lit("d"), doc_id).alias("name"), F.when(doc_id % 97 == 5, "").otherwise(text).alias("definition"))


def mixed_documents(spark, d):
    """Events as documents whose field v is an int, a double, text, an explicit null or missing."""
    e = F.col("event_id")
    v = F.when(e % 5 == 0, F.concat(F.lit(',"v":'), e)).when(e % 5 == 1, F.concat(F.lit(',"v":'), e, F.lit(".5"))).when(
        e % 5 == 2, F.concat(F.lit(',"v":"t'), e, F.lit('"'))).when(e % 5 == 3, ',"v":null').otherwise("")
    n = F.when(e % 2 == 0, F.concat(F.lit(',"n":'), e)).otherwise(F.concat(F.lit(',"n":'), e, F.lit(".25")))
    w = F.when(e % 3 == 0, F.concat(F.lit(',"w":'), e + 5000000000)).otherwise(F.concat(F.lit(',"w":'), e))
    return spread(table(spark, d, "events").select("event_id")).select(
        "event_id", F.concat(F.lit('{"_id":'), e, v, n, w, F.lit("}")).alias("value"))


def instant_documents(spark, d):
    """Events with a field t that is an instant, a number or a boolean, and a field w that is a wrapper or a wider object."""
    e = F.col("event_id")
    t = F.when(e % 3 == 0, F.concat(F.lit('{"$date":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit('"}'))).when(
        e % 3 == 1, e.cast("string")).otherwise("true")
    w = F.concat(F.lit('{"$numberLong":"'), e, F.lit('"'), F.when(e % 2 == 0, "").otherwise(',"x":1'), F.lit("}"))
    return spread(table(spark, d, "events").select("event_id", "ts")).select(
        "event_id", F.concat(F.lit('{"t":'), t, F.lit(',"w":'), w, F.lit("}")).alias("value"))


def order_documents(spark, d):
    """Orders as nested Extended JSON with their lines as an array of items."""
    k = F.col("o_orderkey")
    line = F.struct("l_linenumber", F.col("l_partkey").alias("product"), F.col("l_quantity").cast("int").alias("qty"),
                    F.col("l_extendedprice").alias("price"))
    # both sides are dealt by the order's key once, over enough tasks for the texts that are made of the joined rows
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = table(spark, d, "lineitem").repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(line)).alias("lines"))
    items = F.transform(F.coalesce("lines", F.array()), lambda x: x.dropFields("l_linenumber"))
    orders = table(spark, d, "orders").repartition(tasks, "o_orderkey").join(lines, k == F.col("l_orderkey"), "left")
    return orders.select("o_orderkey", F.to_json(F.struct(
        F.struct(F.lpad(F.hex(k), 24, "0").alias("$oid")).alias("_id"),
        F.struct(F.col("o_custkey").alias("key"), F.struct(F.col("o_orderpriority").alias("level")).alias("priority")).alias(
            "customer"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("$date")).alias("placed"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"), items.alias("items"))).alias("value"))


ORDER_ITEMS_SQL = """(SELECT l_orderkey AS o_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey
 ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INTEGER), l_extendedprice) - 1 AS INTEGER) AS pos,
 l_partkey AS product, CAST(l_quantity AS INTEGER) AS qty, l_extendedprice AS price
 FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""
# The items of each order as one text, which both engines can print.
ORDER_ITEMS_TEXT_SQL = f"""(SELECT o.o_orderkey, coalesce(items, '') AS items FROM orders o LEFT JOIN (SELECT o_orderkey,
 string_agg(product || ':' || qty || ':' || CAST(price AS DECIMAL(18,2)), ';' ORDER BY pos) AS items
 FROM {ORDER_ITEMS_SQL} GROUP BY o_orderkey) i USING (o_orderkey))"""


def items_text(json):
    """That text, from the JSON of an array of items."""
    items = F.from_json(json, "array<struct<product: bigint, qty: int, price: double>>")
    return F.array_join(F.transform(items, lambda x: F.concat_ws(
        ":", x["product"], x["qty"], x["price"].cast("decimal(18,2)"))), ";")
