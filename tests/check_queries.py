"""Compare queries with their SQL in DuckDB: ``python tests/check_queries.py [sf_dir] [name …]``."""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def kind(value):
    return type(value).__name__ if value is not None else None


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.10g}") if math.isfinite(value) else str(value)
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    return value


def compare(spark_rows, spark_columns, sql_rows, sql_columns) -> str | None:
    """None when both hold the same rows, else what differs first."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)} rows"
    order = sorted(spark_columns)

    def table(rows, columns):
        at = [columns.index(c) for c in order]
        return sorted((tuple(normal(r[i]) for i in at) for r in rows), key=repr)

    left, right = table(spark_rows, spark_columns), table(sql_rows, sql_columns)
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"first difference over {order}: {a} != {b}"
        if [kind(x) for x in a] != [kind(x) for x in b]:
            return f"types over {order}: {[kind(x) for x in a]} != {[kind(x) for x in b]}"
    return None


# Spark type names as DuckDB spells them, where they differ.
DUCKDB_NAMES = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                "binary": "BLOB"}


def type_differences(result, con, sql) -> list[str]:
    """Columns whose declared types differ between Spark and DuckDB."""
    declared = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for name, t in result.dtypes:
        expected = DUCKDB_NAMES.get(t, t.upper())
        if expected != declared[name] and not (t == "timestamp" and declared[name].startswith("TIMESTAMP")):
            out.append(f"{name}: {t} / {declared[name]}")
    return out


def check(spark, con, sf_dir, name, fn, sql) -> str | None:
    result = fn(spark, sf_dir)
    rows = result.collect()
    if sql is None:
        return None if rows else "no rows"
    if os.environ.get("SHOW_TYPES"):
        for line in type_differences(result, con, sql):
            print(f"type {name} {line}")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return compare([tuple(r) for r in rows], result.columns, cursor.fetchall(), columns) or (
        "no rows" if not rows else None)


def main() -> int:
    import __spark_entry__ as driver
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(driver.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = check(spark, con, sf_dir, name, driver.queries()[name], driver.oracle_sql().get(name))
        except Exception as e:  # noqa: BLE001 - reported per query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
