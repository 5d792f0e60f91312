"""References as a graph: deletes over all tables, and the order of loading."""

from pyspark.sql import functions as F

from ferrycraft.operators import graph
from ferrycraft.operators.graph import Reference

from . import query, table
from .inputs import dict_fk_columns

# Customers name one who recruited them; 1 and 2 recruited each other. Lines of status F hold their order, complaints
# (events) lose it, and notes (part of the orders) hold it unless they go with it.
_ROWS = """customers AS (SELECT c_custkey AS k, CASE WHEN c_custkey = 1 THEN 2 WHEN c_custkey = 2 THEN 1
  WHEN c_custkey % 3 = 0 THEN c_custkey // 3 END AS up FROM customer),
sales AS (SELECT o_orderkey AS k, o_custkey AS up FROM orders),
lines AS (SELECT l_orderkey AS k, l_linenumber AS n, l_orderkey AS up FROM lineitem WHERE l_orderkey % 4 <> 1),
held AS (SELECT l_orderkey AS k, l_linenumber AS n, l_orderkey AS up FROM lineitem
  WHERE l_orderkey % 4 = 1 AND l_linenumber = 1 AND l_orderkey % 64 = 1),
complaints AS (SELECT event_id AS k, event_id % 5000 AS up FROM events)"""
_KEY = "to_json(struct_pack(k := k))"


def _cascade(spark, d):
    t = lambda name: table(spark, d, name)
    c = F.col("c_custkey")
    items = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_orderkey").alias("up"))
    k = F.col("k")
    tables = {
        "customers": t("customer").select(c.alias("k"), F.when(c == 1, 2).when(c == 2, 1).when(
            c % 3 == 0, F.floor(c / 3)).cast("bigint").alias("up")),
        "sales": t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("up")),
        "lines": items.where(k % 4 != 1),
        "held": items.where((k % 64 == 1) & (F.col("n") == 1)),
        "complaints": t("events").select(F.col("event_id").alias("k"), (F.col("event_id") % 5000).alias("up"))}
    keys = {"customers": ["k"], "sales": ["k"], "lines": ["k", "n"], "held": ["k", "n"], "complaints": ["k"]}
    references = [
        Reference("recruited", "customers", ("up",), "customers", ("k",), "CASCADE"),
        Reference("bought", "sales", ("up",), "customers", ("k",), "CASCADE"),
        Reference("line_of", "lines", ("up",), "sales", ("k",), "CASCADE"),
        Reference("held_by", "held", ("up",), "sales", ("k",), "RESTRICT"),
        Reference("about", "complaints", ("up",), "sales", ("k",), "SET NULL")]
    roots = tables["customers"].where((k % 50 == 1) | (k == 2)).select("k")
    return graph.cascade_delete(tables, keys, references, "customers", roots)


# Every root with all that it reaches; a root goes when nothing that it reaches is held.
_REACH = f"""WITH RECURSIVE {_ROWS},
roots AS (SELECT k AS root FROM customers WHERE k % 50 = 1 OR k = 2),
reach AS (SELECT root, root AS k FROM roots UNION SELECT r.root, c.k FROM reach r JOIN customers c ON c.up = r.k),
bought AS (SELECT DISTINCT root, s.k FROM reach JOIN sales s ON s.up = reach.k),
stopped AS (SELECT root, min(h.k) AS k FROM bought b JOIN held h ON h.up = b.k GROUP BY root),
going AS (SELECT root FROM roots WHERE root NOT IN (SELECT root FROM stopped)),
gone AS (SELECT DISTINCT k FROM bought WHERE root IN (SELECT root FROM going))"""


@query(f"""{_REACH} SELECT DISTINCT 'deleted' AS effect, 'customers' AS table_name, k AS first, 0 AS second, NULL AS reference, NULL AS detail
FROM reach WHERE root IN (SELECT root FROM going) UNION ALL SELECT 'deleted', 'sales', k, 0, NULL, NULL FROM gone
UNION ALL SELECT DISTINCT 'deleted', 'lines', k, n, NULL, NULL FROM lines WHERE up IN (SELECT k FROM gone)
UNION ALL SELECT 'blocked', 'customers', root, 0, 'held_by', (SELECT min('{{"k":' || h.k || ',"n":' || h.n || '}}')
FROM bought b JOIN held h ON h.up = b.k WHERE b.root = s.root) FROM stopped s
UNION ALL SELECT 'changed', 'complaints', k, 0, 'about', 'SET NULL' FROM complaints WHERE up IN (SELECT k FROM gone)""")
def cascade_graph(spark, d):
    """Effect of deleting some customers on all tables: three levels, a cycle, and rows that hold their parents."""
    result = _cascade(spark, d)
    of = lambda name: F.get_json_object("key", f"$.{name}").cast("bigint")
    rows = lambda df, effect, name, reference, detail: df.select(
        F.lit(effect).alias("effect"), name.alias("table_name"), of("k").alias("first"),
        F.coalesce(of("n"), F.lit(0)).cast("int").alias("second"), reference.alias("reference"), detail.alias("detail"))
    none, name = F.lit(None).cast("string"), F.col("table_name")
    return rows(result.deleted, "deleted", name, none, none).union(
        rows(result.blocked, "blocked", F.lit("customers"), F.col("reference"), F.col("held_by_key"))).union(
        rows(result.changed, "changed", name, F.col("reference"), F.col("action")))


# Tables in a chain of halves, cycles of three at every 40th table, and tables that refer to themselves.
_EDGES = """edges AS (SELECT 'T' || p_partkey AS t, 'T' || (p_partkey // 2) AS r FROM part
  UNION SELECT 'T' || p_partkey, 'T' || (p_partkey + 1) FROM part WHERE p_partkey % 40 IN (11, 12)
  UNION SELECT 'T' || p_partkey, 'T' || (p_partkey - 2) FROM part WHERE p_partkey % 40 = 13
  UNION SELECT 'T' || p_partkey, 'T' || p_partkey FROM part WHERE p_partkey % 40 = 5)"""


@query(f"""WITH RECURSIVE {_EDGES}, tables AS (SELECT 'T' || p_partkey AS t FROM part),
known AS (SELECT * FROM edges WHERE r IN (SELECT t FROM tables)),
closure AS (SELECT t, r FROM known UNION SELECT c.t, k.r FROM closure c JOIN known k ON c.r = k.t),
cycles AS (SELECT a.t, least(a.t, min(a.r)) AS cycle FROM closure a JOIN closure b ON a.t = b.r AND a.r = b.t GROUP BY a.t),
home AS (SELECT t, coalesce(cycle, t) AS c FROM tables LEFT JOIN cycles USING (t)),
between AS (SELECT DISTINCT x.c AS a, y.c AS b FROM known JOIN home x USING (t) JOIN home y ON y.t = known.r WHERE x.c <> y.c),
depth AS (SELECT DISTINCT c, 0 AS level FROM home UNION SELECT a, level + 1 FROM depth JOIN between ON b = c)
SELECT t AS table_name, CAST(max(level) AS INTEGER) AS level, cycle,
  CASE WHEN cycle IS NOT NULL THEN (SELECT count(*) FROM cycles o WHERE o.cycle = cycles.cycle) END AS in_cycle_with
FROM home JOIN depth USING (c) LEFT JOIN cycles USING (t) GROUP BY t, cycle""")
def load_order(spark, d):
    """Levels of the tables of a dictionary with chains, cycles and self references."""
    p = F.col("p_partkey")
    part = table(spark, d, "part").select("p_partkey")
    name = lambda n: F.concat(F.lit("T"), n.cast("string"))
    chains = dict_fk_columns(spark, d).select("table_name", "ref_table").distinct()
    edge = lambda rows, to: rows.select(name(p).alias("table_name"), name(to).alias("ref_table"))
    more = edge(part.where((p % 40).isin(11, 12)), p + 1).union(edge(part.where(p % 40 == 13), p - 2)).union(
        edge(part.where(p % 40 == 5), p))
    return graph.load_order(part.select(name(p).alias("table_name")), chains.union(more))
