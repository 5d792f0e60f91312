"""CSV files cut into many splits, line breaks and quotes anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from ferrycraft.sources import readers, split_csv, writers

SCHEMA = StructType([StructField("id", IntegerType()), StructField("a.b", StringType()), StructField("c", StringType())])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(path, rows, line_sep="\n"):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator=line_sep)
    writer.writerows([["id", "a.b", "c"], *rows])
    path.write_text(out.getvalue(), newline="")
    return path.stat().st_size


def made(seed, n):
    rng = random.Random(seed)
    piece = ["plain", "line\nbreak", 'a "quoted" word', "\n\n", "comma, here", "é日", '"', "x" * 300, "y\n" * rng.choice([1, 400]), "\n\"\n"]
    return [[i, "".join(rng.choices(piece, k=rng.randrange(1, 4))), rng.choice(piece)] for i in range(n)]


@pytest.mark.parametrize("seed, line_sep", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_records_over_many_splits(spark, small_splits, tmp_path, seed, line_sep):
    files = {}
    for name in ("one", "two"):
        files[name] = made(seed if name == "one" else seed + 10, 150)
        size = written(tmp_path / f"{name}.csv", files[name], line_sep)
    assert size > 20000
    df = readers.load_csv(spark, str(tmp_path), SCHEMA, line_sep=line_sep)
    assert split_csv.split_states(spark, str(tmp_path)).count() > 20
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r) for rows in files.values() for r in rows)


def test_a_value_longer_than_splits(spark, small_splits, tmp_path):
    """Splits that lie inside one value whole are neither lost nor read as records."""
    rows = [[1, "a,b\n" * 5000, "end"], [2, "c", "d"], [3, '"\n",\n' * 2000, "e"]]
    written(tmp_path / "f.csv", rows)
    df = readers.load_csv(spark, str(tmp_path / "f.csv"), SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [tuple(r) for r in rows]
    assert split_csv.split_states(spark, str(tmp_path / "f.csv")).where("inside").count() > 5


def test_written_and_read_back(spark, small_splits, tmp_path):
    rows = [(i, bytes([i % 256]), None if i % 5 == 0 else f"v\n{i}\r\n\"", "") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, b binary, t string, e string").coalesce(1)
    writers.export_csv(df, str(tmp_path / "out"))
    schema = StructType([StructField("id", IntegerType()), StructField("b", BinaryType()), StructField("t", StringType()),
                         StructField("e", StringType())])
    back = readers.load_csv(spark, str(tmp_path / "out"), schema)
    assert sorted((r["id"], bytes(r["b"]), r["t"], r["e"]) for r in back.collect()) == sorted(rows)


def test_small_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,a.b,c\n1,x,y")
    (tmp_path / "b.csv").write_text("id,a.b,c\n\n2,\\N,\"\"\n\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("id,a.b,c\n")
    df = readers.load_csv(spark, str(tmp_path), SCHEMA)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x", "y"), (2, None, "")]
    (tmp_path / "e.csv").write_text("id,a.b,c\nnot a number,x,y\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.load_csv(spark, str(tmp_path), SCHEMA).collect()
    assert readers.load_csv(spark, str(tmp_path / "a.csv"), SCHEMA, header=False).select("c").collect
