"""Whole migrations and audits."""

from pyspark.sql import functions as F

from ferrycraft.functions.sql_types import ColumnSpec
from ferrycraft.operators import catalog
from ferrycraft.operators.constraints import Constraint
from ferrycraft.plans import migrations as mg
from ferrycraft.session import new_path

from . import inputs, query, table
from .inputs import DEFINITIONS_SQL
from .types import LINEITEM

CUSTOMER = [ColumnSpec("c_custkey", "int"), ColumnSpec("c_name", "nvarchar", max_length=10), ColumnSpec("c_nationkey", "tinyint"),
            ColumnSpec("c_acctbal", "smallmoney"), ColumnSpec("c_mktsegment", "char", max_length=10)]


def _tables(spark, d):
    return {"lineitem": (table(spark, d, "lineitem"), LINEITEM), "customer": (table(spark, d, "customer"), CUSTOMER)}


def _recon(run):
    return run.recon.select("table_name", "source_rows", "target_rows", "status")


@query("""SELECT 'lineitem' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'PASS' AS status FROM lineitem
UNION ALL SELECT 'customer', count(*), count(*), 'PASS' FROM customer""")
def migrate_tables(spark, d):
    return _recon(mg.migrate_tables(spark, _tables(spark, d), new_path(spark, "migrated"), "mysql"))


@query("SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'PASS' AS status FROM customer")
def migrate_to_documents(spark, d):
    only = {"customer": _tables(spark, d)["customer"]}
    return _recon(mg.migrate_to_documents(spark, only, new_path(spark, "documents")))


@query("""SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'PASS' AS status FROM orders
UNION ALL SELECT 'broken', -1, 0, 'ERROR' FROM (SELECT 1)""")
def migrate_documents(spark, d):
    """Order documents to rows; a collection with cut-off documents fails alone, a hidden one is left out."""
    docs = inputs.order_documents(spark, d).select("value")
    cut = docs.withColumn("value", F.substring("value", F.lit(1), F.length("value") - 1))
    return _recon(mg.migrate_documents(spark, {"orders": docs, "broken": cut, "_hidden": docs}, new_path(spark, "rows")))


@query("SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'PASS' AS status FROM customer")
def migrate_append(spark, d):
    """A second run that appends is reconciled by what it added."""
    tables, path = {"customer": _tables(spark, d)["customer"]}, new_path(spark, "appended")
    mg.migrate_tables(spark, tables, path, "mysql", mode="append")
    return _recon(mg.migrate_tables(spark, tables, path, "mysql", mode="append"))


@query("""SELECT 'orders' AS table_name, count(*) FILTER (o_orderkey % 9 <> 0) AS source_rows,
count(*) FILTER (o_orderkey % 9 <> 0) AS target_rows, 'PASS' AS status, count(*) FILTER (o_orderkey % 9 = 0) AS rejected FROM orders""")
def migrate_partly_malformed(spark, d):
    """Every ninth document is cut off: those are kept aside, the others loaded."""
    docs, path = inputs.order_documents(spark, d), new_path(spark, "partly")
    cut = docs.select(F.when(F.col("o_orderkey") % 9 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
    done = mg.migrate_documents(spark, {"orders": cut}, path)
    kept_aside = spark.read.text(f"{path}/_rejected/orders").agg(F.count(F.lit(1)).alias("rejected"))
    return _recon(done).withColumn("rejected", F.lit(kept_aside.first()[0]))


@query("""SELECT 'customer.c_name too long' AS finding, count(*) FILTER (length(c_name) > 10) AS n FROM customer
UNION ALL SELECT 'pk_customer', 0 FROM (SELECT 1)
UNION ALL SELECT 'ck_balance', count(*) FILTER (c_acctbal < 0) FROM customer
UNION ALL SELECT 'blockers', count(*) FILTER (regexp_matches(definition, '\\bEXEC\\s*\\(', 'i')) + count(*) FILTER (regexp_matches(definition, '#\\w+'))
+ count(*) FILTER (regexp_matches(definition, '\\bOPENROWSET\\b', 'i')) + count(*) FILTER (regexp_matches(definition, '\\bFOR\\s+XML\\b', 'i'))
FROM """ + DEFINITIONS_SQL)
def audit_source(spark, d):
    """Findings of a read-only audit: values that do not fit, broken constraints, blockers in definitions."""
    rules = [Constraint("pk_customer", "PRIMARY KEY", "customer", ("c_custkey",)),
             Constraint("ck_balance", "CHECK", "customer", clause="([c_acctbal]>=(0))")]
    audit = mg.audit_source({"customer": _tables(spark, d)["customer"]}, "pg", rules, inputs.definitions(spark, d))
    long = audit.conformance.where((F.col("column_name") == "c_name")).select(
        F.lit("customer.c_name too long").alias("finding"), F.col("too_long").alias("n"))
    broken = audit.constraints.select(F.col("constraint_name").alias("finding"), F.col("violations").alias("n"))
    gate = audit.gate.select(F.lit("blockers").alias("finding"), F.col("blockers").alias("n"))
    return long.unionByName(broken).unionByName(gate)


@query("""SELECT (SELECT count(*) FROM part WHERE p_size % 5 <> 0) AS tables, count(*) FILTER (length(c_name) > 10) AS values_too_long,
0::BIGINT AS failed_values, 1::BIGINT AS valid_constraints, 1::BIGINT AS skipped_constraints,
CASE WHEN count(*) FILTER (c_acctbal < 0) > 0 THEN 1 ELSE 0 END::BIGINT AS broken_constraints, 'FAIL' AS gate, 'FAIL' AS overall FROM customer""")
def audit_report(spark, d):
    """The whole audit in one row: dictionary, values, constraints and definitions."""
    rules = [Constraint("pk_customer", "PRIMARY KEY", "customer", ("c_custkey",)),
             Constraint("ck_balance", "CHECK", "customer", clause="([c_acctbal]>=(0))"),
             Constraint("ck_odd", "CHECK", "customer", clause="(isdate([c_name])=(1))")]
    dictionary = {"tables": catalog.base_tables(inputs.dict_tables(spark, d)), "columns": catalog.table_columns(inputs.dict_columns(spark, d)),
                  "primary": catalog.key_columns(inputs.dict_constraints(spark, d), inputs.dict_key_usage(spark, d)),
                  "indexes": catalog.table_indexes(inputs.dict_indexes(spark, d), inputs.dict_index_columns(spark, d))}
    audit = mg.audit_source({"customer": _tables(spark, d)["customer"]}, "pg", rules, inputs.definitions(spark, d), dictionary)
    return audit.report.select("tables", "values_too_long", "failed_values", "valid_constraints", "skipped_constraints",
                               "broken_constraints", "gate", "overall")
