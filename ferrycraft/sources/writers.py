"""Sinks: tables, CSV staging, documents, reports. Nothing is overwritten unless asked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..functions.text import binary_literal, normalize_text
from ..operators.conform import one_pass
from ..operators.documents import rows_to_documents
from .readers import CSV_NULL, CSV_OPTIONS

# Rows per insert batch.
RELATIONAL_BATCH, DOCUMENT_BATCH = 5000, 1000


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet",
                partition_by: Iterable[str] = ()) -> None:
    """Write a table. With ``partition_by``, ``overwrite`` replaces only the partitions present in ``df``."""
    writer = df.write.format(fmt).mode(mode)
    keys = list(partition_by)
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def jdbc_write_options(url: str, table: str, batch_rows: int = RELATIONAL_BATCH, partitions: int | None = None,
                       column_types: Mapping[str, str] | None = None,
                       options: Mapping[str, str] | None = None) -> dict[str, str]:
    out = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    if partitions:
        out["numPartitions"] = str(partitions)
    if column_types:
        out["createTableColumnTypes"] = ", ".join(f"`{c}` {t}" for c, t in column_types.items())
    return out | dict(options or {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "errorifexists", **kwargs) -> None:
    """Insert over JDBC, one transaction per task.

    A task retried after its commit would insert twice: write to a staging table, check it with
    ``reconcile_counts``, and swap it in on the database side.
    """
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kwargs)).mode(mode).save()


def csv_columns(df: DataFrame, normalize: bool = True) -> DataFrame:
    """Columns as staged CSV holds them: lower-case names, hex literals for bytes, clean NFC text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, BinaryType):
            c = binary_literal(c)
        elif isinstance(f.dataType, StringType) and normalize:
            c = normalize_text(c)
        out.append(c.alias(f.name.lower()))
    return df.select(*out)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists", normalize: bool = True) -> None:
    csv_columns(df, normalize).write.mode(mode).options(**CSV_OPTIONS, emptyValue='""').csv(path)


def csv_null_collisions(df: DataFrame) -> DataFrame:
    """Per text column, values equal to the NULL marker: staged CSV would turn them into NULL."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return one_pass(df, [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(f"`{c}`") == CSV_NULL).alias("collisions"))
        for c in text
    ], "column_name string, collisions bigint")


def write_documents(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Each row as one Extended JSON line."""
    rows_to_documents(df, "value").write.mode(mode).text(path)


def write_collection(df: DataFrame, uri: str, database: str, collection: str, mode: str = "append") -> None:
    """Insert rows as documents through the MongoDB Spark connector, which must be on the class path."""
    (df.toDF(*[c.lower() for c in df.columns]).write.format("mongodb").mode(mode)
     .option("connection.uri", uri).option("database", database).option("collection", collection)
     .option("maxBatchSize", str(DOCUMENT_BATCH)).option("ordered", "false").save())


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Catalogue, findings or reconciliation as JSON lines."""
    df.write.mode(mode).json(path)


def definition_store(definitions: DataFrame, note: str = "Requires manual conversion") -> DataFrame:
    """View definitions kept beside the migrated data, each marked for manual conversion."""
    return definitions.where(F.col("object_type") == "VIEW").select(
        "schema", "name", "definition", F.lit(note).alias("note"))
