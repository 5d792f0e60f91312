"""Scans of tables, documents and staged files, and filters on what to read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..functions.text import parse_binary_literal
from ..operators.documents import parse_documents
from .split_csv import csv_records

# The text that stands for NULL in staged CSV, and rows per round trip to a source.
CSV_NULL = "\\N"
FETCH_ROWS = 5000
CSV_OPTIONS = {
    "header": "true", "nullValue": CSV_NULL, "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None, where: Column | None = None,
               fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Scan with an explicit column list; filter and columns reach the file reader."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def jdbc_source(table: str, columns: Iterable[str], text_cast: Iterable[str] = (), quote: str = '"',
                text_type: str = "VARCHAR(32672)") -> str:
    """Sub-query for ``dbtable``: explicit columns, driver-unsupported types cast to text in the source."""
    casts = set(text_cast)
    q = lambda name: f"{quote}{name}{']' if quote == '[' else quote}"
    items = [f"CAST({q(c)} AS {text_type}) AS {q(c)}" if c in casts else q(c) for c in columns]
    return f"(SELECT {', '.join(items)} FROM {table}) src"


def read_jdbc(spark: SparkSession, url: str, source: str, partition_column: str | None = None,
              lower: str | int | None = None, upper: str | int | None = None, partitions: int | None = None,
              options: Mapping[str, str] | None = None) -> DataFrame:
    """JDBC scan of a table or ``jdbc_source``, split over ``partition_column`` into concurrent range reads.

    Needs the vendor's driver on the class path.
    """
    return spark.read.format("jdbc").options(**jdbc_read_options(
        url, source, partition_column, lower, upper, partitions, options)).load()


def jdbc_read_options(url: str, source: str, partition_column: str | None = None, lower: str | int | None = None,
                      upper: str | int | None = None, partitions: int | None = None,
                      options: Mapping[str, str] | None = None) -> dict[str, str]:
    out = {"url": url, "dbtable": source, "fetchsize": str(FETCH_ROWS)}
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partition column needs lower, upper and partitions")
        out |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions)}
    return out | dict(options or {})


def read_documents(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """JSON lines as ``value`` (text) and ``doc`` (VARIANT); ``limit`` reads the first documents only."""
    lines = spark.read.text(path)
    return parse_documents(lines.limit(limit) if limit else lines)


def read_collection(spark: SparkSession, uri: str, database: str, collection: str) -> DataFrame:
    """A MongoDB collection as Extended JSON documents; needs the MongoDB Spark connector on the class path."""
    whole = '[{"$project": {"_id": 0, "value": "$$ROOT"}}]'
    raw = (spark.read.format("mongodb").option("connection.uri", uri).option("database", database)
           .option("collection", collection).option("aggregation.pipeline", whole)
           .option("outputExtendedJson", "true").schema("value string").load())
    return parse_documents(raw)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def load_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True, line_sep: str = "\n") -> DataFrame:
    """Read a staged CSV back as ``schema``; a value that does not parse fails the job.

    A file is read by as many tasks as it makes splits, also where values hold line breaks (see ``split_csv``).
    """
    raw = StructType([StructField(f.name, StringType() if isinstance(f.dataType, BinaryType) else f.dataType)
                      for f in schema.fields])
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "encoding")}
    # ``multiLine`` keeps line breaks inside quotes as they are
    row = F.from_csv(F.col("text"), _ddl(raw),
                     options | {"emptyValue": "", "multiLine": "true", "mode": "FAILFAST"})
    df = csv_records(spark, path, header, line_sep).select(row.alias("row")).select("row.*")
    return df.select(*[
        (parse_binary_literal(F.col(f"`{f.name}`")) if isinstance(f.dataType, BinaryType) else F.col(f"`{f.name}`")).alias(f.name)
        for f in schema.fields
    ])


def scope_filter(catalog: DataFrame, schema_column: str | None = None, skip_schemas: Iterable[str] = (),
                 name_column: str | None = None, skip_names: Iterable[str] = ()) -> DataFrame:
    """Objects in scope: not in a skipped schema, not a ``system.``/``_`` collection, not a listed name."""
    keep = F.lit(True)
    schemas, names = [s.lower() for s in skip_schemas], list(skip_names)
    if schema_column and schemas:
        keep = keep & ~F.lower(F.col(schema_column)).isin(*schemas)
    if name_column:
        name = F.col(name_column)
        keep = keep & ~F.startswith(name, F.lit("system.")) & ~F.startswith(name, F.lit("_"))
        if names:
            keep = keep & ~name.isin(*names)
    return catalog.where(keep)


def json_field_filter(df: DataFrame, json_column: str, field: str, alias: str | None = None) -> DataFrame:
    """Rows whose JSON object has the key (an explicit null counts), with the field's text added."""
    has_key = F.array_contains(F.json_object_keys(F.col(json_column)), field)
    text = F.get_json_object(F.col(json_column), f"$['{field}']")
    return df.where(has_key).withColumn(alias or field, text)


def spot_check(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, for a look."""
    return df.limit(rows)
