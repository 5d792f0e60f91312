"""Child tables, surrogate keys, entities, profiles."""

from pyspark.sql import functions as F

from ferrycraft.session import new_path
from ferrycraft.operators import normalize as nm
from ferrycraft.operators import profiling as pf
from ferrycraft.operators.documents import parse_documents
from ferrycraft.session import spread

from . import inputs, query, table
from .inputs import ORDER_ITEMS_SQL

ITEM_FIELDS = {"product": (["product"], "bigint"), "qty": (["qty"], "int"), "price": (["price"], "double")}


def _documents(spark, d):
    return parse_documents(inputs.order_documents(spark, d))


@query(f"SELECT o_orderkey, pos, product, qty, price FROM {ORDER_ITEMS_SQL}")
def explode_items(spark, d):
    return nm.explode_child(_documents(spark, d), "o_orderkey", nm.document_array(F.col("doc"), ["items"]), fields=ITEM_FIELDS)


@query("""SELECT DISTINCT p_partkey, unnest([p_brand, p_type, p_brand]) AS tag FROM part""")
def explode_tags(spark, d):
    """JSON array of tags, repeats included, as a junction table."""
    part = table(spark, d, "part").select("p_partkey", F.to_json(F.array("p_brand", "p_type", "p_brand")).alias("tags"))
    return nm.explode_child(part, "p_partkey", nm.json_array(F.col("tags")), value="tag", distinct=True)


@query("""SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def explode_lines(spark, d):
    """Whole texts as arrays of lines."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", F.to_json(F.split("text", "\n")).alias("lines"))
    return nm.explode_child(lines, "doc_id", nm.json_array(F.col("lines")), value="line")


@query("""SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS id, o_custkey, o_orderkey FROM orders""")
def surrogate_keys(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return nm.assign_surrogate_keys(orders, ["o_custkey", "o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, c.id AS part_id FROM lineitem LEFT JOIN
(SELECT p_name, p_partkey, row_number() OVER (ORDER BY p_partkey) AS id FROM part WHERE p_partkey % 6 <> 0) c ON l_partkey = p_partkey""")
def resolve_keys(spark, d):
    """Natural references to surrogate keys; a reference without a parent stays null."""
    parents = nm.assign_surrogate_keys(
        table(spark, d, "part").where(F.col("p_partkey") % 6 != 0).select("p_partkey"), ["p_partkey"])
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return nm.resolve_keys(items, ["l_partkey"], parents, ["p_partkey"], "id", "part_id")


_ENTITY = """(SELECT row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, c_nationkey) AS segment_id, c_mktsegment, c_nationkey
FROM (SELECT DISTINCT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment, c_nationkey FROM customer))"""


def _customers(spark, d):
    return table(spark, d, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")))


@query(f"SELECT * FROM {_ENTITY}")
def extract_entity(spark, d):
    return nm.extract_entity(_customers(spark, d), ["c_mktsegment", "c_nationkey"], "segment_id")[0]


@query(f"""SELECT c.c_custkey, c.c_name, c.c_acctbal, e.segment_id FROM customer c JOIN {_ENTITY} e ON c.c_nationkey = e.c_nationkey AND
(CASE WHEN c.c_mktsegment <> 'MACHINERY' THEN c.c_mktsegment END) IS NOT DISTINCT FROM e.c_mktsegment""")
def entity_references(spark, d):
    """The rows that now hold the entity's key; null attributes match."""
    return nm.extract_entity(_customers(spark, d), ["c_mktsegment", "c_nationkey"], "segment_id")[1]


_LEN = "SELECT '{0}' AS column_name, count(*) AS total, count({1}) AS present, count({1}) = count(*) AS populated, max(length({1})) AS max_chars FROM documents"


@query(f"""SELECT *, 'VARCHAR(' || max_chars || ')' AS suggested FROM (SELECT column_name, total, present, populated,
CAST(max_chars AS INTEGER) AS max_chars FROM ({_LEN.format('text', 'text')} UNION ALL {_LEN.format('lang', 'lang')} UNION ALL
{_LEN.format('source', "CASE WHEN n_chars > 100 THEN source END")}))""")
def length_profile(spark, d):
    docs = table(spark, d, "documents").select(
        "text", "lang", F.when(F.col("n_chars") > 100, F.col("source")).alias("source"))
    return pf.profile_columns(docs)


@query("""SELECT column_name, value, n FROM (SELECT *, count(*) OVER (PARTITION BY column_name) AS distinct_values FROM (
SELECT 'event_type' AS column_name, event_type AS value, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'kind', CAST(event_id % 3 AS VARCHAR), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'event_id', CAST(event_id AS VARCHAR), count(*) FROM events GROUP BY ALL)) WHERE distinct_values <= 20""")
def domain_profile(spark, d):
    """Columns with few values; the keys drop out."""
    events = table(spark, d, "events").select("event_type", (F.col("event_id") % 3).alias("kind"), "user_id", "event_id")
    return pf.profile_domains(events, events.columns)


@query("""SELECT 'l_extendedprice' AS column_name, 0::BIGINT AS changed, 0::BIGINT AS lost, 0::BIGINT AS unsummed,
CAST(sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR) AS sum_before, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS VARCHAR) AS sum_after FROM lineitem
UNION ALL SELECT 'eighth', count(*) FILTER (l_quantity % 2 <> 0), 0, 0, CAST(sum(CAST(CAST(l_quantity / 8 AS VARCHAR) AS DECIMAL(38,18))) AS VARCHAR),
CAST(sum(CAST(l_quantity / 8 AS DECIMAL(12,2))) AS VARCHAR) FROM lineitem""")
def money_totals(spark, d):
    items = table(spark, d, "lineitem").select("l_extendedprice", (F.col("l_quantity") / 8).alias("eighth"))
    return nm.money_totals(items, ["l_extendedprice", "eighth"])


@query(f"""SELECT o_orderkey, pos, product, qty, price, CAST(1 AS BIGINT) AS left_extra, CAST(0 AS BIGINT) AS right_extra FROM {ORDER_ITEMS_SQL}
WHERE product % 50 = 7 UNION ALL SELECT o_orderkey, pos, product, qty + 1, price, 0, 1 FROM {ORDER_ITEMS_SQL} WHERE product % 50 = 7""")
def dual_read_diff(spark, d):
    """The document array against a child table with changed quantities."""
    docs = _documents(spark, d)
    array = nm.document_array(F.col("doc"), ["items"])
    children = nm.explode_child(docs, "o_orderkey", array, fields=ITEM_FIELDS).withColumn(
        "qty", F.when(F.col("product") % 50 == 7, F.col("qty") + 1).otherwise(F.col("qty")))
    return nm.dual_read_diff(docs, "o_orderkey", array, ITEM_FIELDS, children)


@query("""WITH first AS (SELECT p_brand, p_type, dense_rank() OVER (ORDER BY p_brand, p_type) AS id
FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey % 3 = 1)),
more AS (SELECT p_brand, p_type, dense_rank() OVER (ORDER BY p_brand, p_type) + (SELECT count(*) FROM first) AS id
FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE (p_brand, p_type) NOT IN (SELECT (p_brand, p_type) FROM first)))
SELECT p_partkey, id FROM part JOIN (SELECT * FROM first UNION ALL SELECT * FROM more) USING (p_brand, p_type)""")
def kept_surrogate_keys(spark, d):
    """Keys of a first batch stay in the second, which is run twice; new ones continue without a gap."""
    parts, path = table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), new_path(spark, "keys")
    key = ["p_brand", "p_type"]
    nm.extend_surrogate_keys(parts.where(F.col("p_partkey") % 3 == 1), key, path, 0)
    nm.extend_surrogate_keys(parts, key, path, 1)
    return nm.extend_surrogate_keys(parts, key, path, 1).select("p_partkey", "id")
