"""Documents: flattening, schema inference, projection, and rows to documents."""

from pyspark.sql import functions as F

from ferrycraft.operators import documents as dc
from ferrycraft.session import spread, stage
from ferrycraft.sources.writers import definition_store as store

from . import inputs, query, table
from .inputs import DEFINITIONS_SQL, ORDER_ITEMS_TEXT_SQL


def _orders(spark, d):
    return dc.parse_documents(inputs.order_documents(spark, d))


@query(f"""SELECT o_orderkey, unnest([{{'path': '_id', 'v': '{{"$oid":"' || lpad(upper(to_hex(o_orderkey)), 24, '0') || '"}}'}},
{{'path': 'customer.key', 'v': '' || o_custkey}}, {{'path': 'customer.priority.level', 'v': '"' || o_orderpriority || '"'}},
{{'path': 'status', 'v': '"' || o_orderstatus || '"'}}, {{'path': 'total', 'v': CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)}},
{{'path': 'placed', 'v': '{{"$date":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"}}'}}, {{'path': 'items', 'v': items}},
{{'path': 'tags', 'v': '["' || o_orderstatus || '","' || o_orderpriority || '"]'}}], recursive := true)
FROM orders JOIN {ORDER_ITEMS_TEXT_SQL} USING (o_orderkey)""")
def flatten_documents(spark, d):
    """All leaves of the nested order documents as (path, JSON text), numbers with fractions by their value."""
    docs = stage(_orders(spark, d).select("o_orderkey", "doc"), "order-docs")
    flat = dc.flatten_documents(docs, keep=["o_orderkey"]).select(
        "o_orderkey", F.array_join("steps", ".").alias("path"), F.to_json("value").alias("v"))
    value = F.when(F.col("path") == "total", F.col("v").cast("decimal(18,2)").cast("string")).when(
        F.col("path") == "items", inputs.items_text(F.col("v"))).otherwise(F.col("v"))
    return flat.withColumn("v", value)


def _schema(df, profile):
    return dc.infer_schema(df, profile=profile).select("field", "column_name", "target_type", "present")


@query("""SELECT f AS field, replace(f, '.', '_') AS column_name, t AS target_type, (SELECT count(*) FROM orders) AS present
FROM (VALUES ('_id', 'CHAR(24)'), ('customer.key', 'INTEGER'), ('customer.priority.level', 'TEXT'), ('status', 'TEXT'),
('total', 'DOUBLE PRECISION'), ('placed', 'TIMESTAMPTZ'), ('tags', 'JSONB'), ('items', 'JSONB')) v(f, t)""")
def infer_order_schema(spark, d):
    """The levels of the documents are measured, and all are opened."""
    docs = stage(_orders(spark, d).select("doc"), "order-docs")
    return dc.infer_schema(docs, profile="pg").select("field", "column_name", "target_type", "present")


@query("SELECT 'k' AS field, 'k' AS column_name, 'INT' AS target_type, count(*) AS present FROM events")
def infer_event_schema(spark, d):
    return _schema(dc.parse_documents(spread(table(spark, d, "events")), "props"), "mysql")


@query("""SELECT '_id' AS field, '_id' AS column_name, 'INT' AS target_type, count(*) AS present FROM events
UNION ALL SELECT 'v', 'v', 'LONGTEXT', count(*) FILTER (event_id % 5 <> 4) FROM events
UNION ALL SELECT 'n', 'n', 'DOUBLE', count(*) FROM events UNION ALL SELECT 'w', 'w', 'BIGINT', count(*) FROM events""")
def mixed_type_widening(spark, d):
    return _schema(dc.parse_documents(inputs.mixed_documents(spark, d)), "mysql")


@query("""WITH kept AS (SELECT event_id FROM events WHERE CAST('0x' || left(md5('' || event_id), 8) AS BIGINT) < CAST(floor(0.1 * 4294967296) AS BIGINT))
SELECT '_id' AS field, '_id' AS column_name, 'INT' AS target_type, count(*) AS present FROM kept
UNION ALL SELECT 'v', 'v', 'LONGTEXT', count(*) FILTER (event_id % 5 <> 4) FROM kept
UNION ALL SELECT 'n', 'n', 'DOUBLE', count(*) FROM kept UNION ALL SELECT 'w', 'w', 'BIGINT', count(*) FROM kept""")
def sampled_schema(spark, d):
    """Schema from a tenth of the documents, chosen by the hash of their key."""
    docs = dc.parse_documents(inputs.mixed_documents(spark, d))
    return dc.infer_schema(docs, profile="mysql", sample=0.1, sample_by="event_id").select(
        "field", "column_name", "target_type", "present")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def project_events(spark, d):
    docs = dc.parse_documents(spread(table(spark, d, "events").select("event_id", "props")), "props")
    return dc.project_documents(docs, dc.infer_schema(docs), keep=["event_id"])


@query(f"""SELECT lpad(upper(to_hex(o_orderkey)), 24, '0') AS _id, CAST(o_custkey AS INTEGER) AS customer_key,
o_orderpriority AS customer_priority_level, o_orderdate AS placed, o_orderstatus AS status,
'["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags, o_totalprice AS total, items
FROM orders JOIN {ORDER_ITEMS_TEXT_SQL} USING (o_orderkey)""")
def project_orders(spark, d):
    """Order documents parsed once into staged VARIANT, then inferred and projected."""
    docs = stage(_orders(spark, d).select("doc"), "order-docs")
    rows = dc.project_documents(docs, dc.infer_schema(docs))
    return rows.withColumns({"items": inputs.items_text(F.col("items")), "placed": F.col("placed").cast("timestamp_ntz")})


@query("""SELECT event_id AS _id, event_id + CASE WHEN event_id % 2 = 0 THEN 0 ELSE 0.25 END::DOUBLE AS n,
CASE event_id % 5 WHEN 0 THEN '' || event_id WHEN 1 THEN event_id || '.5' WHEN 2 THEN 't' || event_id END AS v,
CASE WHEN event_id % 3 = 0 THEN event_id + 5000000000 ELSE event_id END AS w FROM events""")
def project_mixed(spark, d):
    docs = dc.parse_documents(inputs.mixed_documents(spark, d))
    rows = dc.project_documents(docs, dc.infer_schema(docs, profile="mysql"), "mysql")
    return rows.withColumn("_id", F.col("_id").cast("bigint"))


@query("""SELECT '_id' AS field, 'INT' AS target_type, count(*) AS present, 0::BIGINT AS lost FROM events
UNION ALL SELECT 'n', 'DOUBLE', count(*), 0 FROM events UNION ALL SELECT 'w', 'BIGINT', count(*), 0 FROM events
UNION ALL SELECT 'v', 'LONGTEXT', count(*) FILTER (event_id % 5 < 3), 0 FROM events""")
def audit_projection(spark, d):
    docs = dc.parse_documents(inputs.mixed_documents(spark, d))
    return dc.audit_projection(docs, dc.infer_schema(docs, profile="mysql"), "mysql")


@query("SELECT event_id FROM events WHERE event_id % 9 = 0")
def malformed_documents(spark, d):
    """Every ninth document is cut short."""
    docs = inputs.mixed_documents(spark, d)
    cut = docs.withColumn("value", F.when(F.col("event_id") % 9 == 0, F.expr("left(value, length(value) - 1)")).otherwise(
        F.col("value")))
    return dc.malformed_documents(cut).select("event_id")


@query("""SELECT o_orderkey AS k, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"'
|| o_orderstatus || '","total":{"$numberDecimal":"' || CAST(o_totalprice AS DECIMAL(12,2)) || '"},"placed":{"$date":"'
|| strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000Z') || '"},"note":null}' AS doc FROM orders""")
def orders_to_documents(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "O_CUSTKEY", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("Total"),
        F.col("o_orderdate").alias("placed"), F.lit(None).cast("string").alias("note"))
    return dc.rows_to_documents(orders, keep=["o_orderkey"]).withColumnRenamed("o_orderkey", "k")


@query("""SELECT f AS field, name || CASE WHEN nth > 1 THEN '__' || nth ELSE '' END AS column_name, n > 1 AS collides FROM (
SELECT f, name, row_number() OVER (PARTITION BY name ORDER BY f) AS nth, count(*) OVER (PARTITION BY name) AS n FROM (
SELECT f, lower(replace(f, '.', '_')) AS name FROM (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_brand || '.' || p_type
WHEN 1 THEN p_brand || '_' || p_type ELSE upper(p_brand) || '.' || p_type END AS f FROM part)))""")
def naming_collisions(spark, d):
    """Field names that fold to one column name, and the names they get."""
    p = F.col("p_partkey")
    fields = table(spark, d, "part").select(F.when(p % 3 == 0, F.concat("p_brand", F.lit("."), "p_type")).when(
        p % 3 == 1, F.concat("p_brand", F.lit("_"), "p_type")).otherwise(
        F.concat(F.upper("p_brand"), F.lit("."), "p_type")).alias("field")).distinct()
    return dc.target_names(fields).select("field", "column_name", "collides")


@query(f"""SELECT schema, name, definition, 'Requires manual conversion' AS note FROM {DEFINITIONS_SQL}
WHERE object_type = 'VIEW'""")
def definition_store(spark, d):
    return store(inputs.definitions(spark, d))


@query("""SELECT 't' AS field, 'TIMESTAMPTZ' AS target_type, count(*) AS present, count(*) FILTER (event_id % 3 <> 0) AS lost FROM events
UNION ALL SELECT 'w', 'JSONB', count(*), 0 FROM events""")
def audit_mixed_instants(spark, d):
    """Instants among numbers and booleans, which are no instants; wrappers among objects with more fields."""
    docs = stage(dc.parse_documents(inputs.instant_documents(spark, d)).select("doc"), "instants")
    return dc.audit_projection(docs, dc.infer_schema(docs))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts END AS t, CASE WHEN event_id % 2 = 0 THEN '{"$numberLong":"' || event_id || '"}'
ELSE '{"$numberLong":"' || event_id || '","x":1}' END AS w FROM events""")
def project_mixed_instants(spark, d):
    docs = stage(dc.parse_documents(inputs.instant_documents(spark, d)).select("event_id", "doc"), "instants")
    rows = dc.project_documents(docs, dc.infer_schema(docs), keep=["event_id"])
    return rows.withColumn("t", F.col("t").cast("timestamp_ntz"))


@query(f"""SELECT p_partkey, '{'.'.join(f'l{i}' for i in range(1, 31))}' AS path, '' || p_partkey AS v FROM part
UNION ALL SELECT p_partkey, 'l1.s', '"' || p_brand || '"' FROM part""")
def flatten_deep_documents(spark, d):
    """Documents of thirty levels: the depth is taken from the data."""
    opened = "".join('{"l%d":' % i for i in range(1, 31))
    text = F.concat(F.lit(opened), F.col("p_partkey"), F.lit("}" * 29), F.lit(',"s":"'), F.col("p_brand"), F.lit('"}}'))
    lines = spread(table(spark, d, "part").select("p_partkey", "p_brand")).select("p_partkey", F.replace(text, F.lit("}" * 29 + ","), F.lit("}" * 28 + ",")).alias("value"))
    docs = stage(dc.parse_documents(lines).select("p_partkey", "doc"), "deep")
    leaves = dc.flatten_documents(docs, keep=["p_partkey"])
    return leaves.select("p_partkey", F.array_join("steps", ".").alias("path"), F.to_json("value").alias("v"))
