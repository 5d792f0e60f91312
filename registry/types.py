"""Type mapping, defaults, value conformance."""

from pyspark.sql import functions as F

from ferrycraft.functions import sql_types as st
from ferrycraft.functions import text as tx
from ferrycraft.functions.sql_types import ColumnSpec
from ferrycraft.operators import catalog, conform as cf, documents
from ferrycraft.session import spread

from . import inputs, query, table
from .inputs import DICT_COLUMNS_SQL, sql_literal


# The target of each source type, frozen here so that a change in the tables of the library shows.
_PG_PLAIN = """CASE data_type WHEN 'tinyint' THEN 'smallint' WHEN 'smallint' THEN 'smallint' WHEN 'int' THEN 'integer'
 WHEN 'integer' THEN 'integer' WHEN 'bigint' THEN 'bigint' WHEN 'bit' THEN 'boolean' WHEN 'money' THEN 'numeric(19,4)'
 WHEN 'smallmoney' THEN 'numeric(10,4)' WHEN 'float' THEN 'double precision' WHEN 'real' THEN 'real'
 WHEN 'date' THEN 'date' WHEN 'time' THEN 'time' WHEN 'datetime' THEN 'timestamp' WHEN 'datetime2' THEN 'timestamptz'
 WHEN 'smalldatetime' THEN 'timestamp' WHEN 'datetimeoffset' THEN 'timestamptz' WHEN 'text' THEN 'text'
 WHEN 'ntext' THEN 'text' WHEN 'image' THEN 'bytea' WHEN 'binary' THEN 'bytea' WHEN 'varbinary' THEN 'bytea'
 WHEN 'uniqueidentifier' THEN 'uuid' WHEN 'xml' THEN 'text' WHEN 'geography' THEN 'text' WHEN 'geometry' THEN 'text'
 WHEN 'hierarchyid' THEN 'text' WHEN 'sql_variant' THEN 'text' WHEN 'rowversion' THEN 'bytea'
 WHEN 'timestamp' THEN 'bytea' ELSE 'text' END"""
_MYSQL_PLAIN = """CASE data_type WHEN 'tinyint' THEN 'TINYINT UNSIGNED' WHEN 'smallint' THEN 'SMALLINT'
 WHEN 'int' THEN 'INT' WHEN 'integer' THEN 'INT' WHEN 'bigint' THEN 'BIGINT' WHEN 'bit' THEN 'TINYINT(1)'
 WHEN 'money' THEN 'DECIMAL(19,4)' WHEN 'smallmoney' THEN 'DECIMAL(10,4)' WHEN 'float' THEN 'DOUBLE'
 WHEN 'real' THEN 'FLOAT' WHEN 'date' THEN 'DATE' WHEN 'time' THEN 'TIME' WHEN 'datetime' THEN 'DATETIME'
 WHEN 'datetime2' THEN 'DATETIME(6)' WHEN 'smalldatetime' THEN 'DATETIME' WHEN 'datetimeoffset' THEN 'DATETIME(6)'
 WHEN 'text' THEN 'LONGTEXT' WHEN 'ntext' THEN 'LONGTEXT' WHEN 'image' THEN 'LONGBLOB' WHEN 'binary' THEN 'BLOB'
 WHEN 'varbinary' THEN 'LONGBLOB' WHEN 'uniqueidentifier' THEN 'CHAR(36)' WHEN 'xml' THEN 'LONGTEXT'
 WHEN 'geography' THEN 'LONGTEXT' WHEN 'geometry' THEN 'LONGTEXT' WHEN 'hierarchyid' THEN 'VARCHAR(256)'
 WHEN 'sql_variant' THEN 'LONGTEXT' WHEN 'rowversion' THEN 'BIGINT UNSIGNED' WHEN 'timestamp' THEN 'BIGINT UNSIGNED'
 ELSE 'LONGTEXT' END"""
_BSON_PLAIN = """CASE data_type WHEN 'tinyint' THEN 'int' WHEN 'smallint' THEN 'int' WHEN 'int' THEN 'int'
 WHEN 'integer' THEN 'int' WHEN 'bigint' THEN 'long' WHEN 'bit' THEN 'bool' WHEN 'money' THEN 'decimal128'
 WHEN 'smallmoney' THEN 'decimal128' WHEN 'float' THEN 'double' WHEN 'real' THEN 'double'
 WHEN 'decimal' THEN 'decimal128' WHEN 'numeric' THEN 'decimal128' WHEN 'date' THEN 'date' WHEN 'time' THEN 'string'
 WHEN 'datetime' THEN 'date' WHEN 'datetime2' THEN 'date' WHEN 'smalldatetime' THEN 'date'
 WHEN 'datetimeoffset' THEN 'date' WHEN 'char' THEN 'string' WHEN 'nchar' THEN 'string' WHEN 'varchar' THEN 'string'
 WHEN 'nvarchar' THEN 'string' WHEN 'text' THEN 'string' WHEN 'ntext' THEN 'string' WHEN 'binary' THEN 'binData'
 WHEN 'varbinary' THEN 'binData' WHEN 'image' THEN 'binData' WHEN 'uniqueidentifier' THEN 'string'
 WHEN 'xml' THEN 'string' WHEN 'geography' THEN 'string' WHEN 'geometry' THEN 'string'
 WHEN 'hierarchyid' THEN 'string' WHEN 'sql_variant' THEN 'string' WHEN 'rowversion' THEN 'long'
 WHEN 'timestamp' THEN 'long' ELSE 'string' END"""
_PG = f"""CASE WHEN data_type IN ('varchar', 'nvarchar', 'char', 'nchar') THEN
 CASE WHEN character_maximum_length IS NULL OR character_maximum_length = -1 THEN 'text'
 ELSE 'varchar(' || character_maximum_length || ')' END
 WHEN data_type IN ('decimal', 'numeric') THEN CASE WHEN numeric_precision IS NULL THEN 'numeric'
 WHEN numeric_scale IS NULL THEN 'numeric(' || numeric_precision || ')'
 ELSE 'numeric(' || numeric_precision || ',' || numeric_scale || ')' END
 WHEN data_type = 'float' AND numeric_precision <= 24 THEN 'real' ELSE {_PG_PLAIN} END"""
_MYSQL = f"""CASE WHEN data_type IN ('varchar', 'nvarchar') THEN
 CASE WHEN character_maximum_length IS NULL OR character_maximum_length = -1 THEN 'LONGTEXT'
 WHEN character_maximum_length > 16383 THEN 'MEDIUMTEXT' ELSE 'VARCHAR(' || character_maximum_length || ')' END
 WHEN data_type IN ('char', 'nchar') THEN CASE WHEN character_maximum_length <= 255
 THEN 'CHAR(' || character_maximum_length || ')' ELSE 'VARCHAR(255)' END
 WHEN data_type IN ('decimal', 'numeric') THEN CASE WHEN numeric_precision IS NULL THEN 'DECIMAL(18,4)'
 ELSE 'DECIMAL(' || numeric_precision || ',' || coalesce(numeric_scale, 0) || ')' END
 WHEN data_type = 'float' AND numeric_precision <= 24 THEN 'FLOAT' ELSE {_MYSQL_PLAIN} END"""


def _mapped(spark, d, profile):
    return catalog.table_columns(inputs.dict_columns(spark, d), profile).select(
        "table_name", "column_name", "target_name", "target_type", "nullable", "is_identity", "needs_cast")


def _mapped_sql(expression):
    return f"""SELECT table_name, column_name, lower(column_name) AS target_name, {expression} AS target_type,
 is_nullable = 'YES' AS nullable, is_identity = 1 AS is_identity,
 data_type IN ('geography', 'geometry', 'hierarchyid', 'xml', 'sql_variant') AS needs_cast FROM {DICT_COLUMNS_SQL}"""


@query(_mapped_sql(_PG))
def map_types_pg(spark, d):
    return _mapped(spark, d, "pg")


@query(_mapped_sql(_MYSQL))
def map_types_mysql(spark, d):
    return _mapped(spark, d, "mysql")


@query(_mapped_sql(_BSON_PLAIN))
def map_types_bson(spark, d):
    return _mapped(spark, d, "bson")


def _default_sql(now, utc, precise_now, new_id, type_expression, is_bool):
    """The expected answer by form number, as listed in inputs.DEFAULTS."""
    return f"""SELECT table_name, column_name, CASE form WHEN 1 THEN CASE WHEN p_size = 1 AND {is_bool} THEN 'true'
 ELSE '' || p_size END WHEN 2 THEN '''' || p_type || '''' WHEN 3 THEN '''' || p_brand || '''' WHEN 4 THEN '{now}'
 WHEN 5 THEN '{utc}' WHEN 6 THEN '{new_id}' WHEN 7 THEN 'NULL' WHEN 8 THEN '''''' WHEN 9 THEN
 CASE WHEN {is_bool} THEN 'true' ELSE '1' END WHEN 10 THEN CASE WHEN {is_bool} THEN 'false' ELSE '0' END
 WHEN 13 THEN '-1.5e3' WHEN 14 THEN '7' WHEN 15 THEN '{precise_now}' END AS target_default FROM {DICT_COLUMNS_SQL}"""


def _defaults(spark, d, profile):
    return catalog.table_columns(inputs.dict_columns(spark, d), profile).select(
        "table_name", "column_name", "target_default")


@query(_default_sql("CURRENT_TIMESTAMP", "NOW()", "CURRENT_TIMESTAMP", "gen_random_uuid()", _PG, "data_type = 'bit'"))
def translate_defaults_pg(spark, d):
    return _defaults(spark, d, "pg")


@query(_default_sql("CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP(6)", "(UUID())", _MYSQL, "false"))
def translate_defaults_mysql(spark, d):
    return _defaults(spark, d, "mysql")


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '' || event_id WHEN 1 THEN event_id || '.5'
WHEN 2 THEN 't' || event_id WHEN 3 THEN NULL ELSE 'fallback' END AS v FROM events""")
def apply_defaults(spark, d):
    """A default fills the missing field and leaves the explicit null."""
    docs = documents.parse_documents(inputs.mixed_documents(spark, d))
    value = docs.select("event_id", F.try_variant_get("doc", "$.v", "string").alias("v"),
                        F.try_variant_get("doc", "$.v", "variant").isNull().alias("v_missing"))
    return cf.apply_defaults(value, {"v": F.lit("fallback")}, {"v": F.col("v_missing")}).drop("v_missing")


LINEITEM = [
    ColumnSpec("l_orderkey", "int"), ColumnSpec("l_linenumber", "tinyint"), ColumnSpec("l_partkey", "sql_variant"),
    ColumnSpec("l_quantity", "decimal", precision=6, scale=1), ColumnSpec("l_extendedprice", "money"),
    ColumnSpec("l_discount", "decimal", precision=4, scale=2), ColumnSpec("l_returnflag", "nchar", max_length=1),
    ColumnSpec("l_shipdate", "date"),
]


@query("""SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_quantity AS DECIMAL(6,1)) AS l_quantity,
CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice, CAST(l_discount AS DECIMAL(4,2)) AS l_discount,
l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def conform_lineitem(spark, d):
    return cf.conform(table(spark, d, "lineitem"), LINEITEM)


@query("""SELECT o_orderkey, o_custkey >= 500 AS big, CAST(o_totalprice AS DECIMAL(18,4)) AS total,
CAST(o_orderdate AS DATE)::TIMESTAMP AS placed, CAST(o_custkey AS VARCHAR) AS cust FROM orders""")
def conform_bson(spark, d):
    """Relational values as document values: bit, decimal, date at midnight, uncastable types as text."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") >= 500, 1).otherwise(0).alias("big"), F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").cast("date").alias("placed"), F.col("o_custkey").alias("cust"))
    specs = [ColumnSpec("o_orderkey", "bigint"), ColumnSpec("big", "bit"),
             ColumnSpec("total", "decimal", precision=18, scale=4), ColumnSpec("placed", "date"), ColumnSpec("cust", "xml")]
    return cf.conform(orders, specs, "bson").withColumn("placed", F.col("placed").cast("timestamp_ntz"))


AUDITED = [
    ColumnSpec("l_orderkey", "smallint"), ColumnSpec("l_quantity", "tinyint"),
    ColumnSpec("l_extendedprice", "decimal", precision=7, scale=2), ColumnSpec("l_partkey", "nvarchar", max_length=2),
    ColumnSpec("l_returnflag", "int"), ColumnSpec("code", "uniqueidentifier"), ColumnSpec("weight", "tinyint"),
]


@query("""SELECT * FROM (VALUES ('l_orderkey', 'smallint'), ('l_quantity', 'smallint'), ('l_extendedprice', 'decimal(7,2)'),
('l_partkey', 'string'), ('l_returnflag', 'int'), ('code', 'string'), ('weight', 'smallint')) t(column_name, stored_type)
JOIN (SELECT 'l_orderkey' AS column_name, count(*) AS present, count(*) FILTER (l_orderkey > 32767) AS failed,
 0::BIGINT AS out_of_range, 0::BIGINT AS too_long, NULL::INTEGER AS max_chars FROM lineitem
UNION ALL SELECT 'l_quantity', count(*), 0, 0, 0, NULL FROM lineitem
UNION ALL SELECT 'l_extendedprice', count(*), count(*) FILTER (round(l_extendedprice, 2) >= 100000), 0, 0, NULL FROM lineitem
UNION ALL SELECT 'l_partkey', count(*), 0, 0, count(*) FILTER (l_partkey > 99), CAST(max(length(CAST(l_partkey AS VARCHAR))) AS INTEGER) FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*), count(*), 0, 0, NULL FROM lineitem
UNION ALL SELECT 'code', count(*), 0, 0, count(*) FILTER (l_orderkey % 3 <> 0), max(CASE WHEN l_orderkey % 3 = 0 THEN 36 ELSE 37 END) FROM lineitem
UNION ALL SELECT 'weight', count(*), 0, count(*) FILTER (l_quantity * 10 > 255), 0, NULL FROM lineitem) USING (column_name)""")
def audit_conformance(spark, d):
    uuid = F.when(F.col("l_orderkey") % 3 == 0, F.lit("0f8fad5b-d9cb-469f-a165-70867728950e")).otherwise(
        F.lit("0f8fad5b-d9cb-469f-a165-70867728950e!"))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_partkey", "l_returnflag", uuid.alias("code"),
        (F.col("l_quantity") * 10).alias("weight"))
    return cf.audit_conformance(rows, AUDITED, "mysql")


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_filter([
CASE WHEN l_orderkey > 32767 THEN 'l_orderkey' END, CASE WHEN l_partkey > 99 THEN 'l_partkey' END], lambda x: x IS NOT NULL), ',')
AS bad_columns FROM lineitem WHERE l_orderkey > 32767 OR l_partkey > 99""")
def nonconforming_rows(spark, d):
    bad = cf.nonconforming_rows(table(spark, d, "lineitem"), [AUDITED[0], AUDITED[3]], "pg")
    return bad.select("l_orderkey", "l_linenumber", F.array_join("bad_columns", ",").alias("bad_columns"))


@query("""SELECT doc_id, nfc_normalize(replace(text || CASE WHEN doc_id % 3 = 0 THEN ' e' || chr(769) || 'o' || chr(776) ELSE '' END
|| CASE WHEN doc_id % 7 = 0 THEN 'a' || chr(0) || 'b' ELSE '' END, chr(0), '')) AS text FROM documents""")
def normalize_text(spark, d):
    """Documents with combining marks and NUL characters added."""
    doc_id = F.col("doc_id")
    text = F.concat(F.col("text"), F.when(doc_id % 3 == 0, " e\u0301o\u0308").otherwise(""),
                    F.when(doc_id % 7 == 0, "a\x00b").otherwise(""))
    return spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", tx.normalize_text(text).alias("text"))


@query("SELECT c_custkey, '\\x' || lower(hex(encode(c_name))) AS literal, c_name AS back FROM customer")
def binary_literal(spark, d):
    literal = tx.binary_literal(F.encode("c_name", "UTF-8"))
    return table(spark, d, "customer").select(
        "c_custkey", literal.alias("literal"), F.decode(tx.parse_binary_literal(literal), "UTF-8").alias("back"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished FROM orders")
def boolean_as_int(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", cf.target_bool_as_int(F.col("o_orderstatus") == "F").alias("finished"))


@query("""SELECT p_partkey, lower(replace(replace(p_name || '.$' || p_brand, '.', '_'), '$', '')) AS column_name,
lower(p_brand || '_' || p_name) AS collection, lower(p_brand || '.' || p_name) AS pg_table,
left('idx_' || p_name || '_' || repeat(p_type, 9), 63) AS pg_index, left(repeat(p_type, 12), 64) AS mysql_index FROM part""")
def target_names(spark, d):
    part = table(spark, d, "part")
    return part.select(
        "p_partkey", tx.target_column(F.concat("p_name", F.lit(".$"), "p_brand")).alias("column_name"),
        tx.target_table(F.col("p_brand"), F.col("p_name"), "mysql").alias("collection"),
        tx.target_table(F.col("p_brand"), F.col("p_name")).alias("pg_table"),
        tx.index_identifier(F.col("p_name"), F.repeat("p_type", F.lit(9))).alias("pg_index"),
        tx.index_identifier(F.col("p_name"), F.repeat("p_type", F.lit(12)), "mysql").alias("mysql_index"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 2 THEN NULL ELSE l_orderkey END AS k FROM lineitem""")
def conform_integer_text(spark, d):
    """Integers as text: with leading zeros to 25 digits, plain with a sign, and a number of 25 digits that no BIGINT holds."""
    n = F.col("l_linenumber") % 3
    text = F.when(n == 0, F.lpad(F.col("l_orderkey").cast("string"), 25, "0")).when(
        n == 1, F.concat(F.lit(" +"), F.col("l_orderkey"))).otherwise(F.concat(F.lit("1"), F.lpad(F.col("l_orderkey").cast("string"), 24, "0")))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("k"))
    specs = [ColumnSpec("l_orderkey", "bigint"), ColumnSpec("l_linenumber", "int"), ColumnSpec("k", "bigint")]
    return cf.conform(rows, specs, "pg")
