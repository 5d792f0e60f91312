"""Catalogue assembly over the dictionary derived from ``part``."""

from pyspark.sql import functions as F

from ferrycraft.operators import catalog as c
from ferrycraft.operators import layout
from ferrycraft.operators.reconcile import table_counts as counts_of

from . import inputs, query, table
from .inputs import ACTIONS, DEFINITIONS_SQL, DICT_TABLES_SQL, sql_literal

_ACTION_LIST = "[" + ", ".join(sql_literal(a) for a in ACTIONS) + "]"


@query(f"""SELECT table_schema, table_name, lower(table_schema || '.' || table_name) AS target_table
FROM {DICT_TABLES_SQL} WHERE table_type = 'BASE TABLE' AND lower(table_schema) <> 'brand#3'""")
def base_tables(spark, d):
    return c.base_tables(inputs.dict_tables(spark, d), ["brand#3"])


@query("""SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name, lower('PK_T' || p_partkey) AS constraint_name,
array_to_string(list_transform(range(1, 2 + p_partkey % 3), lambda o: 'col' || (p_partkey % 3 + 2 - o)), ',') AS columns
FROM part""")
def dictionary_keys(spark, d):
    keys = c.key_columns(inputs.dict_constraints(spark, d), inputs.dict_key_usage(spark, d))
    return keys.withColumn("columns", F.array_join("columns", ","))


@query("""SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name, 'uq_t' || p_partkey AS constraint_name,
'col4,col5' AS columns FROM part""")
def dictionary_unique(spark, d):
    keys = c.key_columns(inputs.dict_constraints(spark, d), inputs.dict_key_usage(spark, d), "UNIQUE")
    return keys.withColumn("columns", F.array_join("columns", ","))


@query(f"""SELECT 'fk_t' || p_partkey AS fk_name, upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name,
lower(p_brand) AS ref_schema, 't' || (p_partkey // 2) AS ref_table,
CASE WHEN a = 'SET_DEFAULT' THEN 'RESTRICT' ELSE replace(coalesce(a, 'NO_ACTION'), '_', ' ') END AS on_delete,
CASE WHEN b = 'SET_DEFAULT' THEN 'RESTRICT' ELSE replace(coalesce(b, 'NO_ACTION'), '_', ' ') END AS on_update,
CASE WHEN p_partkey % 2 = 1 THEN 'col1,col2' ELSE 'col1' END AS columns,
CASE WHEN p_partkey % 2 = 1 THEN 'key1,key2' ELSE 'key1' END AS ref_columns
FROM (SELECT *, list_extract({_ACTION_LIST}, p_partkey % 5 + 1) AS a,
list_extract({_ACTION_LIST}, (p_partkey + 1) % 5 + 1) AS b FROM part) WHERE p_partkey % 5 <> 0""")
def dictionary_foreign_keys(spark, d):
    keys = c.foreign_keys(inputs.dict_fk_columns(spark, d), ["dbo"], "mysql")
    return keys.withColumns({n: F.array_join(n, ",") for n in ("columns", "ref_columns")})


@query("""SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name, 'pk_t' || p_partkey AS constraint_name,
CASE WHEN p_size % 2 = 0 THEN '([Size] > ' || p_size || ')' ELSE '([Size] IS NOT NULL)' END AS check_clause FROM part""")
def dictionary_checks(spark, d):
    checks = table(spark, d, "part").select(
        F.concat(F.lit("PK_T"), "p_partkey").alias("constraint_name"), F.upper("p_brand").alias("constraint_schema"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("([Size] > "), "p_size", F.lit(")"))).otherwise(
            "([Size] IS NOT NULL)").alias("check_clause"))
    return c.check_clauses(checks, inputs.dict_constraints(spark, d))


@query("""SELECT upper(p_brand) AS table_schema, 'T' || p_partkey AS table_name, 'ix_t' || p_partkey AS index_name,
p_partkey % 2 = 1 AS is_unique, p_partkey % 6 = 1 AS is_unique_constraint, 'col2,col1' AS columns FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 11 <> 0""")
def dictionary_indexes(spark, d):
    return c.table_indexes(inputs.dict_indexes(spark, d), inputs.dict_index_columns(spark, d))


@query("""SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'events', count(*) FROM events""")
def table_counts(spark, d):
    return counts_of({n: table(spark, d, n) for n in ("lineitem", "orders", "part", "events")})


@query(f"""SELECT object, schema, name, object_type, definition FROM {DEFINITIONS_SQL}
WHERE object_type IN ('VIEW', 'FUNCTION') AND schema <> 'web'""")
def catalog_definitions(spark, d):
    return c.definitions(inputs.definitions(spark, d), ["WEB"], ("VIEW", "FUNCTION"))


@query("""SELECT 'T' || p_partkey AS table_name, 'ix' || p_partkey AS index_name, lower(replace(p_type, '.', '_')) || '_a,name' AS columns
FROM part WHERE p_partkey % 3 <> 0""")
def document_indexes(spark, d):
    p = F.col("p_partkey")
    indexes = table(spark, d, "part").select(
        F.concat(F.lit("T"), p).alias("table_name"),
        F.when(p % 3 == 0, "_id_").otherwise(F.concat(F.lit("ix"), p)).alias("index_name"),
        F.array(F.concat("p_type", F.lit(".A")), F.lit("Name")).alias("keys"))
    return layout.document_indexes(indexes).withColumn("columns", F.array_join("columns", ","))


@query("""SELECT lower(p_name) AS target_table, count(*) AS tables FROM part GROUP BY 1 HAVING count(*) > 1""")
def name_collisions(spark, d):
    named = table(spark, d, "part").select(F.col("p_brand").alias("table_schema"), F.col("p_name").alias("table_name"))
    return c.name_collisions(named)


@query(f"""SELECT t.table_schema, t.table_name,
list_reduce(list_transform(range(1, 2 + p_partkey % 7), lambda i: i || '=Col' || i || '=col' || i), lambda a, b: a || ',' || b) AS columns,
list_reduce(list_transform(range(1 + p_partkey % 3, 0, -1), lambda i: 'col' || i), lambda a, b: a || ',' || b) AS primary_key,
'fk_t' || p_partkey || '(' || CASE p_partkey % 2 WHEN 0 THEN 'col1' ELSE 'col1,col2' END || ')t' || (p_partkey // 2) || '(' ||
CASE p_partkey % 2 WHEN 0 THEN 'key1' ELSE 'key1,key2' END || ')' AS foreign_keys,
CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 11 <> 0 THEN 'ix_t' || p_partkey || '(col2,col1)' || (p_partkey % 2 = 1) ELSE '' END AS indexes
FROM {DICT_TABLES_SQL} t JOIN part ON t.table_name = 'T' || p_partkey WHERE table_type = 'BASE TABLE'""")
def manifest(spark, d):
    """Every list of the assembled manifest, entry by entry."""
    built = c.build_manifest(
        c.base_tables(inputs.dict_tables(spark, d)), c.table_columns(inputs.dict_columns(spark, d)),
        primary=c.key_columns(inputs.dict_constraints(spark, d), inputs.dict_key_usage(spark, d)),
        references=c.foreign_keys(inputs.dict_fk_columns(spark, d)),
        indexes=c.table_indexes(inputs.dict_indexes(spark, d), inputs.dict_index_columns(spark, d)))
    listed = lambda entries, show: F.coalesce(F.array_join(F.transform(entries, show), ","), F.lit(""))
    names = lambda x: F.array_join(x, ",")
    return built.select(
        "table_schema", "table_name",
        listed("columns", lambda x: F.concat_ws("=", x["ordinal_position"], x["column_name"], x["target_name"])).alias("columns"),
        names("primary_key").alias("primary_key"),
        listed("foreign_keys", lambda x: F.concat(x["fk_name"], F.lit("("), names(x["columns"]), F.lit(")"), x["ref_table"], F.lit("("),
                                                  names(x["ref_columns"]), F.lit(")"))).alias("foreign_keys"),
        listed("indexes", lambda x: F.concat(x["index_name"], F.lit("("), x["columns"], F.lit(")"), x["is_unique"])).alias("indexes"))


@query("""SELECT 'T' || p_partkey AS table_name, 'ix' || p_partkey AS index_name, lower(replace(p_type, '.', '_')) || '_a,name' AS columns
FROM part WHERE p_partkey % 3 <> 0""")
def document_indexes(spark, d):
    p = F.col("p_partkey")
    indexes = table(spark, d, "part").select(
        F.concat(F.lit("T"), p).alias("table_name"),
        F.when(p % 3 == 0, "_id_").otherwise(F.concat(F.lit("ix"), p)).alias("index_name"),
        F.array(F.concat("p_type", F.lit(".A")), F.lit("Name")).alias("keys"))
    return layout.document_indexes(indexes).withColumn("columns", F.array_join("columns", ","))


@query("""SELECT lower(p_name) AS target_table, count(*) AS tables FROM part GROUP BY 1 HAVING count(*) > 1""")
def name_collisions(spark, d):
    named = table(spark, d, "part").select(F.col("p_brand").alias("table_schema"), F.col("p_name").alias("table_name"))
    return c.name_collisions(named)


@query(f"""SELECT t.table_schema, t.table_name, 1 + p_partkey % 7 AS column_count,
'pk' || (1 + p_partkey % 3) AS key_size, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 11 <> 0 THEN 1 ELSE 0 END AS index_count
FROM {DICT_TABLES_SQL} t JOIN part ON t.table_name = 'T' || p_partkey WHERE table_type = 'BASE TABLE'""")
def manifest(spark, d):
    """Sizes of the lists in the assembled manifest."""
    built = c.build_manifest(
        c.base_tables(inputs.dict_tables(spark, d)), c.table_columns(inputs.dict_columns(spark, d)),
        primary=c.key_columns(inputs.dict_constraints(spark, d), inputs.dict_key_usage(spark, d)),
        references=c.foreign_keys(inputs.dict_fk_columns(spark, d)),
        indexes=c.table_indexes(inputs.dict_indexes(spark, d), inputs.dict_index_columns(spark, d)))
    return built.select(
        "table_schema", "table_name", F.size("columns").cast("bigint").alias("column_count"),
        F.concat(F.lit("pk"), F.size("primary_key")).alias("key_size"),
        F.when(F.col("indexes").isNull(), 0).otherwise(F.size("indexes")).alias("index_count"))


@query("""SELECT 'T' || p_partkey AS table_name, 'ix' || p_partkey AS index_name, p_partkey % 7 >= 2 AS applicable FROM part""")
def applicable_indexes(spark, d):
    """Indexes on Col1 and Col3 where only tables of three or more columns have both."""
    p = F.col("p_partkey")
    indexes = table(spark, d, "part").select(
        F.concat(F.lit("T"), p).alias("table_name"), F.concat(F.lit("ix"), p).alias("index_name"),
        F.array(F.lit("Col1"), F.lit("Col3")).alias("columns"))
    return layout.applicable_indexes(indexes, inputs.dict_columns(spark, d)).drop("columns")
