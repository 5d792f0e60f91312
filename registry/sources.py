"""Scans, sinks and scope filters."""

from pyspark.sql import functions as F

from ferrycraft.operators.reconcile import table_counts
from ferrycraft.session import new_path
from ferrycraft.sources import readers, writers
from ferrycraft.streaming.incremental import incremental_load, read_incremental

from . import query, table


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 10""")
def read_table(spark, d):
    return readers.read_table(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
                              (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("l_quantity") > 10))


@query("""SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k, ts, ts AS nested_ts,
CAST(value AS DECIMAL(12,2)) AS amount FROM events""")
def document_roundtrip(spark, d):
    """Rows written as JSON documents and read back as VARIANT."""
    path = new_path(spark, "events-json")
    nested = F.array(F.struct("ts", F.col("value").cast("decimal(12,2)").alias("amount")))
    writers.write_documents(table(spark, d, "events").withColumn("nested", nested), path)
    doc = lambda p, t: F.try_variant_get("doc", p, t)
    return readers.read_documents(spark, path).select(
        doc("$.event_id", "bigint").alias("event_id"), doc("$.user_id", "bigint").alias("user_id"),
        doc("$.event_type", "string").alias("event_type"), doc("$.value", "double").alias("value"),
        F.get_json_object(doc("$.props", "string"), "$.k").cast("int").alias("k"),
        doc("$.ts['$date']", "timestamp").cast("timestamp_ntz").alias("ts"),
        doc("$.nested[0].ts['$date']", "timestamp").cast("timestamp_ntz").alias("nested_ts"),
        doc("$.nested[0].amount['$numberDecimal']", "decimal(12,2)").alias("amount"))


@query("SELECT doc_id, nfc_normalize(replace(text, chr(0), '')) AS text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, d):
    """Texts with quotes, commas and line breaks staged as CSV and loaded back."""
    docs, path = table(spark, d, "documents"), new_path(spark, "documents-csv")
    writers.export_csv(docs, path)
    return readers.load_csv(spark, path, docs.schema)


@query("SELECT 'text' AS column_name, count(*) AS collisions FROM documents WHERE doc_id % 50 = 7")
def csv_null_collisions(spark, d):
    marked = table(spark, d, "documents").select(
        F.when(F.col("doc_id") % 50 == 7, F.lit("\\N")).otherwise(F.col("text")).alias("text"))
    return writers.csv_null_collisions(marked)


@query("SELECT event_type, count(*) AS n, sum(CAST(value AS DECIMAL(12,2))) AS total FROM events GROUP BY event_type")
def incremental_copy(spark, d):
    """Streaming copy of the events, then totals over the copied rows."""
    path = new_path(spark, "events-copy")
    schema = table(spark, d, "events").schema
    incremental_load(spark, d, f"{path}/rows", f"{path}/checkpoint", schema, pattern="events.parquet")
    return read_incremental(spark, f"{path}/rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(38,2)").alias("total"))


@query("SELECT CAST(count(*) AS DOUBLE) AS rows FROM events")
def incremental_rows(spark, d):
    """Rows that a copy in several batches reports."""
    path, events = new_path(spark, "events-batches"), table(spark, d, "events")
    events.repartition(6).write.parquet(f"{path}/source")
    done = incremental_load(spark, f"{path}/source", f"{path}/rows", f"{path}/checkpoint", events.schema, files_per_batch=1)
    return spark.createDataFrame([(float(done["rows"]),)], "rows double")


@query("""SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'click' OR event_id % 2 = 0
GROUP BY event_type""")
def partition_overwrite(spark, d):
    """Re-loading one partition replaces it and leaves the others."""
    events, path = table(spark, d, "events"), new_path(spark, "events-parts")
    writers.write_table(events, path, partition_by=["event_type"])
    again = events.where((F.col("event_type") == "click") & (F.col("event_id") % 2 == 0))
    writers.write_table(again, path, mode="overwrite", partition_by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'documents', count(*) FROM documents""")
def report_roundtrip(spark, d):
    """Row counts written as a JSON report and read back."""
    path = new_path(spark, "report")
    counts = table_counts({n: table(spark, d, n) for n in ("orders", "lineitem", "documents")})
    writers.write_report(counts, path)
    return spark.read.schema("table_name string, row_count bigint").json(path)


_COLLECTIONS = """SELECT p_brand AS schema_name, CASE p_size % 10 WHEN 0 THEN 'system.' || p_name
WHEN 1 THEN '_' || p_name ELSE p_name END AS name, p_partkey FROM part"""


@query(f"""SELECT schema_name, name, p_partkey FROM ({_COLLECTIONS})
WHERE NOT starts_with(name, 'system.') AND NOT starts_with(name, '_')
AND lower(schema_name) NOT IN ('brand#1', 'brand#12') AND name NOT IN ('red widget')""")
def scope_filter(spark, d):
    part = table(spark, d, "part")
    name = F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("system."), "p_name")).when(
        F.col("p_size") % 10 == 1, F.concat(F.lit("_"), "p_name")).otherwise(F.col("p_name"))
    catalog = part.select(F.col("p_brand").alias("schema_name"), name.alias("name"), "p_partkey")
    return readers.scope_filter(catalog, "schema_name", ["Brand#1", "Brand#12"], "name", ["red widget"])


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
WHERE json_exists(props, '$.k') AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 10""")
def json_field_filter(spark, d):
    events = table(spark, d, "events").select("event_id", "props")
    return readers.json_field_filter(events, "props", "k").where(F.col("k").cast("int") < 10).select("event_id", "k")


@query("""SELECT event_type, user_id, n FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)
ORDER BY n DESC, event_type, user_id LIMIT 5""")
def spot_check(spark, d):
    counts = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return readers.spot_check(counts.orderBy(F.desc("n"), "event_type", "user_id"), 5)
