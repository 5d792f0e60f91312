"""The source's dictionary as catalogue tables.

Inputs are one database's dictionary tables as DataFrames; every function is one set-based query over all
tables, not a query per table. Columns are the usual INFORMATION_SCHEMA ones in lower case.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sql_types import map_type, needs_text_cast, translate_default
from ..functions.text import target_table

_TABLE = ("table_schema", "table_name")


def base_tables(tables: DataFrame, skip_schemas: Iterable[str] = (), profile: str = "pg") -> DataFrame:
    """Base tables in scope with their target name, ordered."""
    skip = [s.lower() for s in skip_schemas]
    kept = tables.where(F.col("table_type") == "BASE TABLE")
    if skip:
        kept = kept.where(~F.lower("table_schema").isin(*skip))
    return kept.select(
        *_TABLE, target_table(F.col("table_schema"), F.col("table_name"), profile).alias("target_table"),
    ).orderBy(*_TABLE)


def table_columns(columns: DataFrame, profile: str = "pg") -> DataFrame:
    """Columns with target name and type, nullability, translated default, identity and cast flags."""
    mapped = map_type(profile, F.col("data_type"), F.col("character_maximum_length"),
                      F.col("numeric_precision"), F.col("numeric_scale"))
    out = columns.withColumn("target_type", mapped)
    default = F.lit(None).cast("string") if profile == "bson" else translate_default(
        F.col("column_default"), F.col("target_type"), profile)
    return out.select(
        *_TABLE, "column_name", F.lower("column_name").alias("target_name"), "ordinal_position", "data_type",
        "target_type", (F.col("is_nullable") == "YES").alias("nullable"), "column_default",
        default.alias("target_default"), F.coalesce(F.col("is_identity") == 1, F.lit(False)).alias("is_identity"),
        needs_text_cast(F.col("data_type")).alias("needs_cast"),
    )


def ordered_list(position: Column, value: Column) -> Column:
    """Aggregate: values in position order. For key columns, of which a constraint has a few dozen at most."""
    pairs = F.sort_array(F.collect_list(F.struct(position.alias("p"), value.alias("v"))))
    return F.transform(pairs, lambda x: x["v"])


def _constraint_columns(constraints: DataFrame, usage: DataFrame, kind: str) -> DataFrame:
    chosen = constraints.where(F.col("constraint_type") == kind).select("constraint_name", *_TABLE)
    parts = usage.select("constraint_name", "table_schema", "column_name", "ordinal_position")
    return chosen.join(parts, ["constraint_name", "table_schema"])


def key_columns(constraints: DataFrame, usage: DataFrame, kind: str = "PRIMARY KEY") -> DataFrame:
    """Primary keys or UNIQUE constraints with their columns in key order."""
    return _constraint_columns(constraints, usage, kind).groupBy(*_TABLE, "constraint_name").agg(
        ordered_list(F.col("ordinal_position"), F.lower("column_name")).alias("columns"),
    ).withColumn("constraint_name", F.lower("constraint_name"))


def foreign_keys(fk_columns: DataFrame, skip_schemas: Iterable[str] = (), profile: str = "pg") -> DataFrame:
    """One row per foreign key, composite keys as arrays; keys into skipped schemas are left out.

    MySQL has no SET DEFAULT and gets RESTRICT.
    """
    skip = [s.lower() for s in skip_schemas]
    kept = fk_columns.where(~F.lower("ref_schema").isin(*skip)) if skip else fk_columns

    def action(name: str) -> Column:
        text = F.replace(F.coalesce(F.col(name), F.lit("NO_ACTION")), F.lit("_"), F.lit(" "))
        return F.when(text == "SET DEFAULT", "RESTRICT").otherwise(text) if profile == "mysql" else text

    return kept.groupBy(
        F.lower("fk_name").alias("fk_name"), *_TABLE, F.lower("ref_schema").alias("ref_schema"),
        F.lower("ref_table").alias("ref_table"), action("on_delete").alias("on_delete"),
        action("on_update").alias("on_update"),
    ).agg(
        ordered_list(F.col("ordinal_position"), F.lower("column_name")).alias("columns"),
        ordered_list(F.col("ordinal_position"), F.lower("ref_column")).alias("ref_columns"),
    )


def check_clauses(checks: DataFrame, constraints: DataFrame) -> DataFrame:
    """CHECK clauses with the table they belong to."""
    owners = constraints.select(
        F.col("constraint_name"), F.col("table_schema"), F.col("table_name"))
    return checks.withColumnRenamed("constraint_schema", "table_schema").join(
        owners, ["constraint_name", "table_schema"]).select(
        *_TABLE, F.lower("constraint_name").alias("constraint_name"), "check_clause")


def table_indexes(indexes: DataFrame, index_columns: DataFrame) -> DataFrame:
    """Secondary indexes with key columns in order, comma separated. INCLUDE columns are not part of the key.

    ``is_unique_constraint`` marks indexes that a UNIQUE constraint brings along, so they are not created twice; a
    dictionary without that column marks none.
    """
    backing = F.col("is_unique_constraint") == 1 if "is_unique_constraint" in indexes.columns else F.lit(False)
    chosen = indexes.where((F.col("is_primary_key") == 0) & F.col("index_name").isNotNull()).select(
        *_TABLE, "index_name", "is_unique", F.coalesce(backing, F.lit(False)).alias("is_unique_constraint"))
    parts = index_columns.where(F.col("key_ordinal") > 0).select(*_TABLE, "index_name", "column_name", "key_ordinal")
    return chosen.join(parts, [*_TABLE, "index_name"]).groupBy(
        *_TABLE, "index_name", "is_unique", "is_unique_constraint").agg(
        F.array_join(ordered_list(F.col("key_ordinal"), F.lower("column_name")), ",").alias("columns"),
    ).withColumns({"index_name": F.lower("index_name"), "is_unique": F.col("is_unique") == 1})


def definitions(routines: DataFrame, skip_schemas: Iterable[str] = (),
                kinds: Sequence[str] = ("VIEW", "FUNCTION", "PROCEDURE")) -> DataFrame:
    """Views, functions and procedures in scope, with an empty text for a missing definition."""
    skip = [s.lower() for s in skip_schemas]
    kept = routines.where(F.col("object_type").isin(*kinds))
    if skip:
        kept = kept.where(~F.lower("schema").isin(*skip))
    return kept.select(
        F.concat_ws(".", "schema", "name").alias("object"), "schema", "name", "object_type",
        F.coalesce("definition", F.lit("")).alias("definition"))


def name_collisions(tables: DataFrame, profile: str = "mysql", drop_schema: bool = True) -> DataFrame:
    """Target table names that several source tables share when the schema is dropped."""
    target = F.lower("table_name") if drop_schema else target_table(
        F.col("table_schema"), F.col("table_name"), profile)
    return tables.groupBy(target.alias("target_table")).agg(F.count(F.lit(1)).alias("tables")).where(
        F.col("tables") > 1)


def build_manifest(tables: DataFrame, columns: DataFrame, primary: DataFrame | None = None,
                   unique: DataFrame | None = None, references: DataFrame | None = None,
                   checks: DataFrame | None = None, indexes: DataFrame | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """One nested row per table: columns, keys, references, checks, indexes, row count.

    Lists hold one table's dictionary entries, which the source database bounds.
    """
    def nested(df: DataFrame, alias: str, first: str) -> DataFrame:
        rest = [c for c in df.columns if c not in _TABLE and c != first]
        return df.groupBy(*_TABLE).agg(F.sort_array(F.collect_list(F.struct(first, *rest))).alias(alias))

    out = tables.join(nested(columns, "columns", "ordinal_position"), list(_TABLE), "left")
    if primary is not None:
        out = out.join(primary.select(*_TABLE, F.col("columns").alias("primary_key")), list(_TABLE), "left")
    for df, alias, first in ((unique, "unique_constraints", "constraint_name"), (references, "foreign_keys", "fk_name"),
                             (checks, "check_constraints", "constraint_name"), (indexes, "indexes", "index_name")):
        if df is not None:
            out = out.join(nested(df, alias, first), list(_TABLE), "left")
    if counts is not None:
        out = out.join(counts.select("target_table", F.col("row_count").alias("source_row_count")), "target_table", "left")
    return out
