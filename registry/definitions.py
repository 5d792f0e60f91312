"""Compatibility scan and view rewriting."""

from pyspark.sql import functions as F

from ferrycraft.operators import definitions as df
from ferrycraft.operators.catalog import definitions as scoped

from . import inputs, query, table
from .inputs import DEFINITIONS_SQL, sql_literal


def _findings_sql(profile):
    rules = ", ".join(f"({', '.join(sql_literal(x) for x in rule)})" for rule in df.RULES[profile])
    return f"""SELECT object, object_type, severity, issue FROM {DEFINITIONS_SQL}, (VALUES {rules}) r(pattern, severity, issue)
WHERE definition <> '' AND regexp_matches(definition, pattern, 'i')"""


def _findings(spark, d, profile):
    return df.scan_definitions(inputs.definitions(spark, d), profile)


@query(_findings_sql("pg"))
def scan_definitions_pg(spark, d):
    return _findings(spark, d, "pg")


@query(_findings_sql("mysql"))
def scan_definitions_mysql(spark, d):
    return _findings(spark, d, "mysql")


@query(_findings_sql("bson"))
def scan_definitions_bson(spark, d):
    return _findings(spark, d, "bson")


@query(f"""SELECT CASE WHEN count(*) FILTER (severity = 'BLOCKER') > 0 THEN 'FAIL' ELSE 'PASS' END AS gate,
count(*) FILTER (severity = 'BLOCKER') AS blockers, count(*) FILTER (severity = 'WARNING') AS warnings,
count(*) FILTER (severity = 'INFO') AS info FROM ({_findings_sql('mysql')})""")
def compatibility_gate(spark, d):
    return df.compatibility_gate(_findings(spark, d, "mysql"))


# View texts by form, {k} from the row, with the body expected for a MySQL target named shop.
FORMS = [
    ("SELECT [P_Name] FROM [dbo].[Part] WHERE [P_PartKey] = {k}", "SELECT `p_name` FROM `part` WHERE `p_partkey` = {k}"),
    ("CREATE VIEW [Sales].[v{k}] AS\nSELECT a AS b FROM [Sales].[Order Lines]", "SELECT a AS b FROM `shop`.`order lines`"),
    ("SET ANSI_NULLS ON\nGO\nSET QUOTED_IDENTIFIER ON;\nGO\nCREATE VIEW [dbo].[v{k}] ([A], [B]) WITH SCHEMABINDING, ENCRYPTION AS\n"
     "WITH t AS (SELECT {k} AS x) SELECT x FROM t\nGO", "WITH t AS (SELECT {k} AS x) SELECT x FROM t"),
    ("create view vBas{k} as select 1 as one", "select 1 as one"),
    ("CREATE OR REPLACE VIEW dbo.v{k} AS SELECT \"Total\" = [Qty] * {k}, \"Name\" = n FROM dbo.t",
     "SELECT [qty] * {k} AS `total`, n AS `name` FROM t"),
    ("CREATE VIEW [Person].[v{k}] AS SELECT * FROM [Person].[A] CROSS APPLY f({k})", None),
    ("  ", None),
    ("CREATE VIEW dbo.v{k} AS SELECT \"X\" = coalesce(a, [B], {k}), [y] = a, z = (SELECT \"Q\" = max(c), 1 FROM dbo.u), 'dbo.keep' AS w -- dbo.note\n"
     "FROM [dbo].[T] WHERE [x] = 'SELECT \"A\" = 1' AND \"b\" = 2",
     "SELECT coalesce(a, `b`, {k}) AS `x`, a AS `y`, (SELECT max(c) AS `q`, 1 FROM u) AS `z`, 'dbo.keep' AS w -- dbo.note\n"
     "FROM `t` WHERE `x` = 'SELECT \"A\" = 1' AND \"b\" = 2"),
    ("CREATE VIEW v{k} AS SELECT f(a, 'it''s ' + b FROM t", None),
]


def _form_sql(index):
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if f[index] is None else sql_literal(f[index]).replace('{k}', chr(39) + ' || p_partkey || ' + chr(39))}"
        for i, f in enumerate(FORMS))
    return f"CASE p_partkey % {len(FORMS)} {arms} END"


def views(spark, d):
    k = F.col("p_partkey")
    text = F.lit(None).cast("string")
    for i, (source, _) in enumerate(FORMS):
        text = F.when(k % len(FORMS) == i, F.replace(F.lit(source), F.lit("{k}"), k.cast("string"))).otherwise(text)
    kinds = F.element_at(F.array(F.lit("VIEW"), F.lit("VIEW"), F.lit("FUNCTION"), F.lit("PROCEDURE")), (
        F.floor(k / 7) % 4 + 1).cast("int"))
    return table(spark, d, "part").select(
        F.lit("dbo").alias("schema"), F.concat(F.lit("v"), k).alias("name"), kinds.alias("object_type"), text.alias("definition"))


@query(f"""SELECT 'v' || p_partkey AS name, CASE p_partkey % {len(FORMS)} WHEN 5 THEN 'MANUAL' WHEN 8 THEN 'MANUAL' WHEN 6 THEN 'SKIPPED' ELSE 'READY' END AS status,
CASE p_partkey % {len(FORMS)} WHEN 5 THEN 'CROSS APPLY' WHEN 6 THEN 'empty definition' WHEN 8 THEN 'text is cut off' END AS reason,
CASE WHEN p_partkey % {len(FORMS)} NOT IN (5, 6, 8) THEN replace(replace({_form_sql(1)}, '[', '`'), ']', '`') END AS body
FROM part WHERE (p_partkey // 7) % 4 < 2""")
def rewrite_definitions(spark, d):
    out = df.rewrite_definitions(views(spark, d), "shop", ["dbo"])
    return out.select("name", "status", "reason", F.when(F.col("status") == "READY", F.col("body")).alias("body"))


@query(f"""SELECT 'dbo.v' || p_partkey AS object, CASE WHEN (p_partkey // 7) % 4 = 2 THEN 'FUNCTION' ELSE 'PROCEDURE' END AS object_type,
'requires manual rewrite' AS action FROM part WHERE (p_partkey // 7) % 4 >= 2 AND p_partkey % {len(FORMS)} <> 6""")
def manual_worklist(spark, d):
    return df.manual_worklist(scoped(views(spark, d)))


@query("""SELECT p_partkey, '[Size' || p_size || '] > 0' AS stripped, '`size' || p_size || '` > 0' AS clause FROM part""")
def translate_checks(spark, d):
    """CHECK clauses without their wrapping parentheses, identifiers quoted for the target."""
    from ferrycraft.functions.sql_types import strip_outer_parens

    clause = F.concat(F.lit("(([Size"), "p_size", F.lit("] > 0))"))
    stripped = strip_outer_parens(clause)
    return table(spark, d, "part").select("p_partkey", stripped.alias("stripped"), df.quote_identifiers(stripped).alias("clause"))
