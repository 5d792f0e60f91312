"""Readers, writers, incremental copies and whole migrations."""

import datetime
import decimal
import json
import os

import pytest
from pyspark.sql import functions as F

from ferrycraft.functions.sql_types import ColumnSpec
from ferrycraft.operators.constraints import Constraint
from ferrycraft.operators.reconcile import diff_tables
from ferrycraft.plans import migrations as mg
from ferrycraft.session import scratch, shared_dir, spread, stage
from ferrycraft.sources import readers, writers
from ferrycraft.streaming.incremental import incremental_load, read_incremental


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame([
        (1, 'quote " and, comma', bytearray(b"\x00\xff"), decimal.Decimal("1.50"), datetime.datetime(2024, 1, 2, 3, 4, 5), True),
        (2, "line\nbreak\r\nand tab\t", bytearray(b""), None, None, False), (3, "", None, decimal.Decimal("0.00"), None, None),
        (4, None, None, None, None, None), (5, " padded ", None, None, None, None), (6, 'end"', None, None, None, None),
        (7, "back\\slash", None, None, None, None), (8, "nul\x00é", None, None, None, None), (9, '""', None, None, None, None),
    ], "id int, s string, raw binary, m decimal(9,2), at timestamp, b boolean")


def test_csv_round_trip(spark, odd, tmp_path):
    path = str(tmp_path / "csv")
    writers.export_csv(odd, path)
    clean = odd.withColumn("s", F.when(F.col("id") == 8, "nulé").otherwise(F.col("s")))
    assert diff_tables(clean, readers.load_csv(spark, path, odd.schema)).collect() == []


def test_csv_null_marker(spark):
    df = spark.createDataFrame([("\\N", "a"), ("\\N", None), ("N", "\\N")], "x string, y string")
    assert dict(writers.csv_null_collisions(df).collect()) == {"x": 2, "y": 1}


def test_documents_written_and_read(spark, odd, tmp_path):
    path = str(tmp_path / "docs")
    writers.write_documents(odd.where("id <= 2"), path)
    docs = {r["value"] for r in readers.read_documents(spark, path).collect()}
    first = json.loads(min(docs))
    assert first["m"] == {"$numberDecimal": "1.50"} and first["raw"] == {"$binary": {"base64": "AP8=", "subType": "00"}}
    assert first["at"] == {"$date": "2024-01-02T03:04:05.000000Z"} and first["b"] is True
    assert readers.read_documents(spark, path, limit=1).count() == 1


def test_nothing_is_overwritten_by_default(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_table(spark.range(3), path)
    writers.write_table(spark.range(5), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5


def test_jdbc_options():
    query = readers.jdbc_source("[dbo].[t]", ["id", "geo"], ["geo"], quote="[", text_type="NVARCHAR(MAX)")
    assert query == "(SELECT [id], CAST([geo] AS NVARCHAR(MAX)) AS [geo] FROM [dbo].[t]) src"
    options = readers.jdbc_read_options("jdbc:x", query, "id", 1, 100, 8)
    assert options["numPartitions"] == "8" and options["fetchsize"] == "5000"
    with pytest.raises(ValueError):
        readers.jdbc_read_options("jdbc:x", query, "id")
    assert writers.jdbc_write_options("jdbc:x", "t", column_types={"a": "CHAR(3)"})["createTableColumnTypes"] == "`a` CHAR(3)"


def test_scan_pushes_filter_and_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).selectExpr("id", "id * 2 as b", "id * 3 as c").write.parquet(path)
    plan = readers.read_table(spark, path, ["id", "b"], F.col("id") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert stage(spark.range(7)).count() == 7
    assert spread(spark.range(10, numPartitions=1), 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(10, numPartitions=9), 4).rdd.getNumPartitions() == 4


def test_incremental_load_resumes_and_repeats_nothing(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    put = lambda lo, hi: spark.range(lo, hi, numPartitions=2).write.mode("append").parquet(source)
    put(0, 50)
    schema = spark.range(1).schema
    first = incremental_load(spark, source, target, checkpoint, schema, files_per_batch=1)
    assert first["rows"] == 50 and len([d for d in os.listdir(target) if d.startswith("batch_id=")]) == 2
    put(50, 80)
    assert incremental_load(spark, source, target, checkpoint, schema, files_per_batch=1)["rows"] == 30
    assert incremental_load(spark, source, target, checkpoint, schema)["rows"] == 0
    rows = sorted(r[0] for r in read_incremental(spark, target, schema).collect())
    assert rows == list(range(80))


def test_incremental_load_after_a_failed_batch(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, numPartitions=1).write.mode("append").parquet(source)
    calls = []

    def breaks(df):
        calls.append(1)
        if len(calls) == 2:
            df.write.mode("overwrite").parquet(f"{target}/batch_id=1")  # written, but never committed
            raise RuntimeError("executor lost")
        return df

    schema = spark.range(1).schema
    with pytest.raises(Exception, match="executor lost"):
        incremental_load(spark, source, target, checkpoint, schema, files_per_batch=1, transform=breaks)
    incremental_load(spark, source, target, checkpoint, schema, files_per_batch=1)
    assert sorted(r[0] for r in read_incremental(spark, target, schema).collect()) == list(range(30))


SPECS = [ColumnSpec("Id", "int"), ColumnSpec("Name", "nvarchar", max_length=5), ColumnSpec("Price", "money"), ColumnSpec("Geo", "geography")]


@pytest.fixture()
def shop(spark):
    return spark.createDataFrame([(1, "a", 1.5, "P"), (2, "toolong", 2.25, None)], "Id int, Name string, Price double, Geo string")


def test_tables_to_tables_and_one_failure(spark, shop, tmp_path):
    missing = [ColumnSpec("Nope", "int")]
    run = mg.migrate_tables(spark, {"good": (shop, SPECS), "bad": (shop, missing)}, str(tmp_path / "t"), "mysql")
    status = {r["table_name"]: (r["status"], r["source_rows"], r["target_rows"]) for r in run.recon.collect()}
    assert status == {"good": ("PASS", 2, 2), "bad": ("ERROR", -1, 0)}
    assert run.report.first()["summary"]["overall"] == "FAIL" and run.metrics["good"]["rows"] == 2
    assert spark.read.parquet(str(tmp_path / "t/good")).columns == ["id", "name", "price", "geo"]


def test_tables_to_documents_and_back(spark, shop, tmp_path):
    out = str(tmp_path / "d")
    assert mg.migrate_to_documents(spark, {"shop": (shop, SPECS)}, out).report.first()["summary"]["overall"] == "PASS"
    lines = spark.read.text(f"{out}/shop")
    bad = spark.createDataFrame([("{",)], "value string")
    run = mg.migrate_documents(spark, {"Shop": lines, "_hidden": lines, "system.x": lines, "skipme": lines, "broken": bad},
                               str(tmp_path / "r"), skip=["skipme"])
    assert {r["table_name"]: r["status"] for r in run.recon.collect()} == {"Shop": "PASS", "broken": "ERROR"}
    back = spark.read.parquet(str(tmp_path / "r/shop"))
    assert sorted((r["id"], r["name"], r["price"], r["geo"]) for r in back.collect()) == [
        (1, "a", decimal.Decimal("1.5"), "P"), (2, "toolong", decimal.Decimal("2.25"), None)]


def test_audit_moves_nothing(spark, shop):
    views = spark.createDataFrame([("dbo.v", "VIEW", "SELECT TOP 5 * FROM #t")], "object string, object_type string, definition string")
    audit = mg.audit_source({"shop": (shop, SPECS)}, "pg", [Constraint("pk", "PRIMARY KEY", "shop", ("Id",))], views)
    assert {r["column_name"]: r["too_long"] for r in audit.conformance.collect()}["name"] == 1
    assert audit.constraints.first()["status"] == "VALID" and audit.gate.first()["gate"] == "FAIL"


def test_every_batch_is_counted(spark, tmp_path):
    """Progress reports keep the last hundred batches only."""
    source = str(tmp_path / "in")
    spark.range(0, 260, numPartitions=130).write.parquet(source)
    done = incremental_load(spark, source, str(tmp_path / "out"), str(tmp_path / "check"), spark.range(1).schema, files_per_batch=1)
    assert done["rows"] == 260 and read_incremental(spark, str(tmp_path / "out")).count() == 260


def test_scratch_drops_what_was_staged(spark):
    kept = stage(spark.range(3))
    with scratch(spark):
        gone = stage(spark.range(5))
        assert gone.count() == 5
        path = gone.inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3


def test_a_collection_with_malformed_lines_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    lines = spark.createDataFrame([('{"a":1}',), ('{"a":',), ('{"a":2}',), (None,)], "value string").mapInArrow(counted, "value string")
    done = mg.migrate_documents(spark, {"c": lines}, f"{tmp_path}/rows")
    assert done.rejected == {"c": 1} and read.value == 4
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/rows/_rejected/c").collect()] == ['{"a":']
    assert sorted(r["a"] for r in spark.read.parquet(f"{tmp_path}/rows/c").collect()) == [1, 2]
