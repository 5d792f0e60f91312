"""Constraint audits and resolutions, and index-shaped layouts."""

from pyspark.sql import functions as F

from ferrycraft.operators import constraints as ct
from ferrycraft.operators import layout, postings
from ferrycraft.operators.constraints import Constraint
from ferrycraft.session import new_path, spread

from . import query, table


@query("""SELECT 'user_id' AS column_name, count(*) FILTER (event_id % 13 = 0) AS nulls FROM events
UNION ALL SELECT 'event_type', count(*) FILTER (value > 90) FROM events
UNION ALL SELECT 'event_id', 0 FROM (SELECT 1)""")
def not_null_report(spark, d):
    events = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 13 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("value") <= 90, F.col("event_type")).alias("event_type"))
    return ct.check_not_null(events, ["user_id", "event_type", "event_id"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, 'duplicate' AS problem FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_line_keys(spark, d):
    return ct.check_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT k AS l_orderkey, l_linenumber, count(*) AS n, CASE WHEN k IS NULL THEN 'null' ELSE 'duplicate' END AS problem
FROM (SELECT CASE WHEN l_suppkey % 10 <> 3 THEN l_orderkey END AS k, l_linenumber FROM lineitem) GROUP BY ALL
HAVING count(*) > 1 OR k IS NULL""")
def primary_key_with_nulls(spark, d):
    rows = table(spark, d, "lineitem").withColumn("l_orderkey", F.when(F.col("l_suppkey") % 10 != 3, F.col("l_orderkey")))
    return ct.check_key(rows, ["l_orderkey", "l_linenumber"])


@query("""SELECT sha256(text) AS text, count(*) AS n, 'duplicate' AS problem FROM documents GROUP BY 1 HAVING count(*) > 1""")
def unique_text(spark, d):
    """Equal texts, found by their digests."""
    return ct.check_key(table(spark, d, "documents"), ["text"], nulls="distinct", digest=True)


@query("""SELECT k AS user_id, count(*) AS n, 'duplicate' AS problem FROM (SELECT CASE WHEN user_id % 4 <> 0 THEN user_id END AS k
FROM events) GROUP BY 1 HAVING count(*) > 1""")
def unique_nulls_equal(spark, d):
    """UNIQUE where only one null is allowed."""
    rows = table(spark, d, "events").select(F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("user_id"))
    return ct.check_key(rows, ["user_id"], nulls="equal")


@query("""SELECT left(text, 191) AS text, count(*) AS n, 'duplicate' AS problem FROM documents GROUP BY 1 HAVING count(*) > 1""")
def prefix_key(spark, d):
    """A unique index on the first characters is stricter than one on the whole text."""
    return ct.check_key(table(spark, d, "documents"), ["text"], nulls="distinct", prefix=ct.TEXT_PREFIX)


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
(SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def duplicate_rows(spark, d):
    return ct.duplicate_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])


def _kept_orders(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderkey") % 7 != 0)


@query("""SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN
(SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0) GROUP BY 1""")
def orphan_keys(spark, d):
    return ct.check_foreign_key(table(spark, d, "lineitem"), ["l_orderkey"], _kept_orders(spark, d), ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey NOT IN
(SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0)""")
def orphan_lineitems(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ct.orphan_rows(items, ["l_orderkey"], _kept_orders(spark, d), ["o_orderkey"])


@query("""SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_partkey % 11 <> 0 AND (l_partkey, l_suppkey) NOT IN
(SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_linenumber = 1) GROUP BY 1, 2""")
def composite_orphans(spark, d):
    """Two-column reference; a key with a null part is not checked."""
    items = table(spark, d, "lineitem")
    child = items.select(F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("l_partkey"), "l_suppkey")
    parent = items.where(F.col("l_linenumber") == 1).select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    return ct.check_foreign_key(child, ["l_partkey", "l_suppkey"], parent, ["p", "s"])


_KEPT = "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0"


@query(f"SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN ({_KEPT}) GROUP BY 1")
def orphans_deleted(spark, d):
    left = ct.resolve_orphans(table(spark, d, "lineitem"), ["l_orderkey"], _kept_orders(spark, d), "delete", ["o_orderkey"])
    return left.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT CASE WHEN l_orderkey IN ({_KEPT}) THEN l_orderkey ELSE 1 END AS l_orderkey, count(*) AS n
FROM lineitem GROUP BY 1""")
def orphans_reassigned(spark, d):
    left = ct.resolve_orphans(table(spark, d, "lineitem"), ["l_orderkey"], _kept_orders(spark, d), "reassign",
                              ["o_orderkey"], reassign_to={"l_orderkey": 1})
    return left.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL
SELECT DISTINCT l_orderkey, NULL FROM lineitem WHERE l_orderkey NOT IN ({_KEPT})""")
def orphans_given_parents(spark, d):
    parents = _kept_orders(spark, d).select("o_orderkey", "o_orderstatus")
    return ct.resolve_orphans(table(spark, d, "lineitem"), ["l_orderkey"], parents, "placeholder", ["o_orderkey"])


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def check_acctbal(spark, d):
    return ct.check_expression(table(spark, d, "customer"), "(([C_AcctBal]>=(0)))").select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT event_id, event_type, value FROM events WHERE NOT (value BETWEEN 1 AND 50 AND regexp_matches(event_type, '^[a-m]'))""")
def range_and_pattern_check(spark, d):
    return ct.check_expression(table(spark, d, "events"), "value BETWEEN 1 AND 50 AND event_type rlike '^[a-m]'").select(
        "event_id", "event_type", "value")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def domain_check(spark, d):
    return ct.check_domain(table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) GROUP BY 1")
def domain_table_check(spark, d):
    """A domain held in a table."""
    domain = table(spark, d, "supplier").where(F.col("s_acctbal") > 2000).select("s_suppkey")
    return ct.check_domain(table(spark, d, "lineitem"), "l_suppkey", domain)


def _deleted(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") == "P").select("o_orderkey")


_GONE = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN ({_GONE})")
def cascade_delete(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ct.apply_delete(items, ["l_orderkey"], _deleted(spark, d), "CASCADE", ["o_orderkey"])


@query(f"""SELECT CASE WHEN l_orderkey NOT IN ({_GONE}) THEN l_orderkey END AS l_orderkey, l_linenumber, l_partkey FROM lineitem""")
def set_null_delete(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ct.apply_delete(items, ["l_orderkey"], _deleted(spark, d), "SET NULL", ["o_orderkey"])


@query(f"SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IN ({_GONE})")
def restrict_delete(spark, d):
    return ct.apply_delete(table(spark, d, "lineitem"), ["l_orderkey"], _deleted(spark, d), "RESTRICT", ["o_orderkey"])


RULES = [
    Constraint("nn_order", "NOT NULL", "lineitem", ("l_orderkey", "l_linenumber")),
    Constraint("ck_price", "CHECK", "lineitem", clause="([l_extendedprice] > 0 AND [l_discount] <= 0.05)"),
    Constraint("dm_flag", "DOMAIN", "lineitem", ("l_returnflag",), allowed=("A", "R")),
    Constraint("pk_line", "PRIMARY KEY", "lineitem", ("l_orderkey", "l_linenumber")),
    Constraint("fk_order", "FOREIGN KEY", "lineitem", ("l_orderkey",), ref_table="orders", ref_columns=("o_orderkey",)),
    Constraint("fk_line", "FOREIGN KEY", "orders", ("o_orderkey",), ref_table="lineitem", ref_columns=("l_orderkey",)),
    Constraint("pk_order", "PRIMARY KEY", "orders", ("o_orderkey",)),
    Constraint("ck_bal", "CHECK", "orders", clause="(([o_totalprice]>(1000)))"),
    Constraint("ck_like", "CHECK", "orders", clause="(len([o_orderstatus])=(1) AND [o_orderpriority] like '[1-3]-%')"),
    Constraint("ck_bad", "CHECK", "orders", clause="(isdate([o_orderdate])=(1))"),
    Constraint("dm_gone", "DOMAIN", "lineitem", ("l_color",), allowed=("A",)),
    Constraint("fk_no_column", "FOREIGN KEY", "lineitem", ("l_orderkey",), ref_table="orders"),
    Constraint("dm_texts", "DOMAIN", "lineitem", ("l_linenumber",), allowed=("1", "2", "three")),
    Constraint("ck_cast", "CHECK", "orders", clause="(CAST(left([o_orderpriority],(2)) AS [int])>(2) OR [o_orderstatus]='F')"),
    Constraint("ck_ratio", "CHECK", "lineitem", clause="(([l_extendedprice]/([l_linenumber]-(1)))>(5000))"),
]
_REPORT = """SELECT 'nn_order' AS constraint_name, 'NOT NULL' AS kind, 'lineitem' AS table_name, 0::BIGINT AS violations, 0::BIGINT AS unevaluated, 'VALID' AS status
UNION ALL SELECT 'ck_price', 'CHECK', 'lineitem', count(*) FILTER (NOT (l_extendedprice > 0 AND l_discount <= 0.05)), 0, 'VIOLATED' FROM lineitem
UNION ALL SELECT 'dm_flag', 'DOMAIN', 'lineitem', count(*) FILTER (l_returnflag NOT IN ('A', 'R')), 0, 'VIOLATED' FROM lineitem
UNION ALL SELECT 'pk_line', 'PRIMARY KEY', 'lineitem', count(*) - count(DISTINCT (l_orderkey, l_linenumber)), 0, 'VIOLATED' FROM lineitem
UNION ALL SELECT 'fk_order', 'FOREIGN KEY', 'lineitem', count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)), 0, 'VALID' FROM lineitem
UNION ALL SELECT 'fk_line', 'FOREIGN KEY', 'orders', count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)), 0, 'INVALID_PARENT' FROM orders
UNION ALL SELECT 'pk_order', 'PRIMARY KEY', 'orders', count(*) - count(DISTINCT o_orderkey), 0, 'VALID' FROM orders
UNION ALL SELECT 'ck_bal', 'CHECK', 'orders', count(*) FILTER (o_totalprice <= 1000), 0,
CASE WHEN count(*) FILTER (o_totalprice <= 1000) > 0 THEN 'VIOLATED' ELSE 'VALID' END FROM orders
UNION ALL SELECT 'ck_like', 'CHECK', 'orders', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-3]-')), 0, 'VIOLATED' FROM orders
UNION ALL SELECT 'ck_bad', 'CHECK', 'orders', NULL, NULL, 'SKIPPED'
UNION ALL SELECT 'dm_gone', 'DOMAIN', 'lineitem', NULL, NULL, 'SKIPPED'
UNION ALL SELECT 'fk_no_column', 'FOREIGN KEY', 'lineitem', NULL, NULL, 'SKIPPED'
UNION ALL SELECT 'dm_texts', 'DOMAIN', 'lineitem', count(*) FILTER (l_linenumber NOT IN (1, 2)), 0, 'VIOLATED' FROM lineitem
UNION ALL SELECT 'ck_cast', 'CHECK', 'orders', 0, count(*) FILTER (o_orderstatus <> 'F'), 'VALID' FROM orders
UNION ALL SELECT 'ck_ratio', 'CHECK', 'lineitem', count(*) FILTER (l_linenumber > 1 AND l_extendedprice / (l_linenumber - 1) <= 5000),
count(*) FILTER (l_linenumber = 1), 'VIOLATED' FROM lineitem"""


def _report(spark, d):
    return ct.audit_constraints({n: table(spark, d, n) for n in ("lineitem", "orders")}, RULES)


@query(_REPORT)
def constraint_report(spark, d):
    """Two of the constraints can't be resolved; the others are audited all the same."""
    return _report(spark, d).drop("reason")


@query(f"""SELECT kind, count(*) FILTER (status = 'VALID') AS added, count(*) FILTER (status <> 'VALID') AS skipped
FROM ({_REPORT}) GROUP BY kind""")
def constraint_tally(spark, d):
    return ct.constraint_tally(_report(spark, d))


@query("SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'")
def clustered_read(spark, d):
    """A range filter on the clustering key reads few row groups."""
    path = new_path(spark, "lineitem-by-date")
    items = table(spark, d, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    layout.write_clustered(items, path, ["l_shipdate"], tie_break=["l_orderkey"])
    return spark.read.schema(items.schema).parquet(path).where(
        F.col("l_shipdate").between(F.lit("1997-03-01").cast("timestamp"), F.lit("1997-03-31").cast("timestamp")))


_AXES = [("l_partkey", 100, 140), ("l_suppkey", 3, 5), ("l_quantity", 10.0, 11.0)]


@query(" UNION ALL ".join(f"SELECT '{c}' AS filter, count(*) AS matching, true AS skips FROM lineitem WHERE {c} BETWEEN {low} AND {high}"
                          for c, low, high in _AXES))
def curve_clustering(spark, d):
    """Files dealt along a curve through three columns: a filter on any one of them skips some."""
    path = new_path(spark, "lineitem-by-curve")
    items = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_orderkey", "l_linenumber")
    columns = [c for c, _, _ in _AXES]
    layout.write_multi_clustered(items, path, columns, 64)
    kept = spark.read.schema(items.schema).parquet(path)
    matching = kept.agg(*[F.count_if(F.col(c).between(low, high)).alias(c) for c, low, high in _AXES]).unpivot(
        [], columns, "filter", "matching")
    return layout.files_to_read(kept, columns, _AXES).join(matching, "filter").select(
        "filter", "matching", ((F.col("files_read") < F.col("files")) & (F.col("rows_read") >= F.col("matching"))).alias("skips"))


def _postings(spark, d):
    path = new_path(spark, "postings")
    postings.write_postings(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", path)
    return spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/lengths")


_TERMS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"


@query(f"""SELECT doc_id AS doc, count(*) AS hits FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i
FROM (SELECT doc_id, {_TERMS} AS w FROM documents)) WHERE w[i:i + 2] = ['of', 'the', 'the'] GROUP BY doc_id""")
def phrase_search(spark, d):
    """Three words one behind the other, from postings with positions."""
    blocks, _ = _postings(spark, d)
    return postings.search_phrase(blocks, "Of the, THE")


@query(f"""WITH words AS (SELECT doc_id AS doc, {_TERMS} AS w FROM documents),
lengths AS (SELECT doc, len(w) AS length FROM words WHERE len(w) > 0), n AS (SELECT count(*) AS total, avg(length) AS mean FROM lengths),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(w) AS term FROM words) WHERE term IN ('public', 'the', 'license', 'edoution') GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc, round(sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 9) AS score
FROM tf JOIN df USING (term) JOIN lengths USING (doc), n GROUP BY doc ORDER BY score DESC, doc LIMIT 25""")
def ranked_search(spark, d):
    """The best 25 documents for some words, ties by the smaller document."""
    blocks, lengths = _postings(spark, d)
    return postings.search_ranked(blocks, lengths, "the public license edoution", 25)


@query("""SELECT DISTINCT term, doc_id FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term
FROM documents) WHERE term <> ''""")
def term_index(spark, d):
    return layout.build_term_index(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")


@query("""SELECT doc_id FROM (SELECT DISTINCT term, doc_id FROM (SELECT doc_id,
unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM documents) WHERE term IN ('the', 'of'))
GROUP BY doc_id HAVING count(*) = 2""")
def term_search(spark, d):
    """Search over a term index written clustered by term."""
    path = new_path(spark, "terms")
    index = layout.build_term_index(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text")
    layout.write_term_index(index, path, "doc_id")
    return layout.search_terms(spark.read.schema(index.schema).parquet(path), "doc_id", ["The", "of"])


@query("""SELECT conv_id FROM (SELECT DISTINCT conv_id, term FROM (SELECT conv_id,
unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM conversations) WHERE term IN ('the', 'of'))
GROUP BY conv_id HAVING count(*) = 2""")
def term_search_by_group(spark, d):
    """Conversations, of several rows each, that hold both terms somewhere."""
    index = layout.build_term_index(table(spark, d, "conversations").select("conv_id", "text"), "conv_id", "text")
    return layout.search_terms(index, "conv_id", ["The", "of"])
