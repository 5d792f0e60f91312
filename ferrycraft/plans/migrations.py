"""End-to-end migrations between tables and documents, and the read-only audit.

Each run is a short driver program over lazy plans: per table one read-convert-write job that counts its own
rows on the way, then one reconciliation. One table's failure becomes an ERROR row and the run goes on.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.sql_types import ColumnSpec
from ..operators.catalog import build_manifest
from ..operators.conform import audit_conformance, conform
from ..operators.constraints import Constraint, audit_constraints
from ..operators.definitions import compatibility_gate, scan_definitions
from ..operators.documents import (
    infer_schema,
    parse_documents,
    project_documents,
    rows_to_documents,
    schema_rows,
)
from ..operators.reconcile import load_metrics, migration_report, reconcile_counts
from ..session import STAGED, new_path
from ..sources.writers import write_table


@dataclass
class Migration:
    """Outcome of a run: ``recon`` per table, nested ``report``, rows, seconds and rows/s per table, and the
    malformed documents kept aside per collection."""

    recon: DataFrame
    report: DataFrame
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)


def _run(spark: SparkSession, jobs: Mapping[str, Callable[[], tuple[DataFrame, str, str]]], mode: str) -> Migration:
    """``jobs``: table name to a function giving (rows to write, path, format)."""
    loaded, errors, metrics = [], [], {}
    for name, job in jobs.items():
        started = time.monotonic()
        try:
            rows, path, fmt = job()
            seen = Observation()
            read = spark.read if fmt == "text" else spark.read.schema(rows.schema)
            before = read.format(fmt).load(path).count() if mode == "append" and _exists(spark, path) else 0
            write_table(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode, fmt)
            n = seen.get["rows"]
            loaded.append((name, n, read.format(fmt).load(path).count() - before))
            metrics[name] = load_metrics(n, time.monotonic() - started)
        except Exception as e:  # noqa: BLE001 - reported per table
            errors.append((name, str(e)))
    schema = "table_name string, row_count bigint"
    source = spark.createDataFrame([(t, s) for t, s, _ in loaded] + [(t, -1) for t, _ in errors], schema)
    target = spark.createDataFrame([(t, w) for t, _, w in loaded] + [(t, 0) for t, _ in errors], schema)
    issues = spark.createDataFrame(errors, "table_name string, issue string")
    recon = reconcile_counts(source, target, issues)
    return Migration(recon, migration_report(recon), metrics)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def migrate_tables(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Iterable[ColumnSpec]]], target: str,
                   profile: str = "pg", mode: str = "errorifexists") -> Migration:
    """Relational to relational: each table conformed and written under ``target``."""
    def job(name: str):
        df, specs = tables[name]
        return lambda: (conform(df, specs, profile), f"{target}/{name}", "parquet")
    return _run(spark, {name: job(name) for name in tables}, mode)


def migrate_to_documents(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Iterable[ColumnSpec]]],
                         target: str, mode: str = "errorifexists") -> Migration:
    """Relational to documents: one Extended JSON line per row."""
    def job(name: str):
        df, specs = tables[name]
        return lambda: (rows_to_documents(conform(df, specs, "bson"), "value"), f"{target}/{name}", "text")
    return _run(spark, {name: job(name) for name in tables}, mode)


def migrate_documents(spark: SparkSession, collections: Mapping[str, DataFrame], target: str, profile: str = "pg",
                      sample: int | float | None = None, mode: str = "errorifexists",
                      skip: Iterable[str] = ()) -> Migration:
    """Documents to relational: text parsed once into staged VARIANT, schema inferred, rows projected.

    ``collections``: name to JSON lines in column ``value``. Malformed lines are written to ``_rejected/<name>`` under
    the target and the rest is loaded; ``rejected`` of the result counts them. A collection with nothing else is an
    ERROR.
    """
    rejected: dict[str, int] = {}

    def job(name: str):
        def run():
            seen, staged = Observation(), new_path(spark, "documents")
            parsed = parse_documents(collections[name].select("value"))
            malformed = F.col("value").isNotNull() & F.col("doc").isNull()
            counted = parsed.observe(seen, F.count_if(malformed).alias("malformed"), F.count("doc").alias("good"))
            counted.select("doc", F.when(malformed, F.col("value")).alias("value")).where(
                "doc IS NOT NULL OR value IS NOT NULL").write.options(**STAGED).parquet(staged)
            kept = spark.read.schema("doc variant, value string").parquet(staged)
            if bad := seen.get["malformed"]:
                rejected[name] = bad
                kept.where("doc IS NULL").select("value").write.mode(mode).text(f"{target}/_rejected/{name.lower()}")
                if not seen.get["good"]:
                    raise ValueError(f"{bad} malformed documents")
            docs = kept.where("doc IS NOT NULL").select("doc")
            schema = schema_rows(infer_schema(docs, profile=profile, sample=sample))
            return project_documents(docs, schema, profile), f"{target}/{name.lower()}", "parquet"
        return run
    skipped = set(skip)
    names = [n for n in collections
             if n not in skipped and not n.startswith("system.") and not n.startswith("_")]
    done = _run(spark, {name: job(name) for name in sorted(names)}, mode)
    return Migration(done.recon, done.report, done.metrics, rejected)


@dataclass
class Audit:
    """Read-only findings about a source."""

    conformance: DataFrame | None
    constraints: DataFrame | None
    findings: DataFrame | None
    gate: DataFrame | None
    manifest: DataFrame | None = None
    report: DataFrame | None = None


def audit_source(tables: Mapping[str, tuple[DataFrame, Iterable[ColumnSpec]]], profile: str = "pg",
                 constraints: Iterable[Constraint] = (), definitions: DataFrame | None = None,
                 dictionary: Mapping[str, DataFrame] | None = None) -> Audit:
    """What a migration would meet, without moving data: values that do not fit, broken constraints, constructs
    to rewrite. All results are lazy.

    ``dictionary``: the arguments of ``build_manifest`` (``tables``, ``columns``, ``primary``, …); with it the audit has
    the manifest of the whole source. ``report`` is one row: what each part found, and PASS when nothing stands in the
    way.
    """
    parts = [audit_conformance(df, specs, profile).select(F.lit(name).alias("table_name"), "*")
             for name, (df, specs) in tables.items()]
    conformance = None
    for p in parts:
        conformance = p if conformance is None else conformance.unionByName(p)
    constraints = list(constraints)
    broken = audit_constraints({n: df for n, (df, _) in tables.items()}, constraints) if constraints else None
    findings = scan_definitions(definitions, profile) if definitions is not None else None
    gate = compatibility_gate(findings) if findings is not None else None
    manifest = build_manifest(**dictionary) if dictionary else None
    return Audit(conformance, broken, findings, gate, manifest, _audit_report(conformance, broken, gate, manifest))


def _audit_report(conformance: DataFrame | None, broken: DataFrame | None, gate: DataFrame | None,
                  manifest: DataFrame | None) -> DataFrame | None:
    """One row from the parts that there are, each of them one aggregate row."""
    parts = []
    if manifest is not None:
        parts.append(manifest.agg(F.count(F.lit(1)).alias("tables"), F.sum(F.size("columns")).alias("columns")))
    if conformance is not None:
        parts.append(conformance.agg(
            F.sum("failed").alias("failed_values"), F.sum("out_of_range").alias("values_out_of_range"),
            F.sum("too_long").alias("values_too_long")))
    if broken is not None:
        parts.append(broken.agg(
            F.count_if(F.col("status") == "VALID").alias("valid_constraints"),
            F.count_if(F.col("status") == "SKIPPED").alias("skipped_constraints"),
            F.count_if(~F.col("status").isin("VALID", "SKIPPED")).alias("broken_constraints")))
    if gate is not None:
        parts.append(gate.select("gate", "blockers", "warnings", "info"))
    if not parts:
        return None
    out = parts[0].withColumn("__one", F.lit(1))
    for p in parts[1:]:
        out = out.join(p.withColumn("__one", F.lit(1)), "__one")
    bad = [F.col(c) > 0 for c in ("failed_values", "values_out_of_range", "values_too_long", "broken_constraints", "blockers")
           if c in out.columns]
    failed = reduce(lambda a, b: a | b, bad) if bad else F.lit(False)
    return out.drop("__one").withColumn("overall", F.when(failed, "FAIL").otherwise("PASS"))
