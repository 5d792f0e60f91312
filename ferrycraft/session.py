"""Session defaults, and the shared folder where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session time zone is fixed so that instants and zone-less timestamps convert the same way everywhere.
# The forced skew split keeps AQE's skew handling on even when a later aggregate reuses the join's
# partitioning: an extra shuffle is cheaper than one task holding a third of the rows.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# Staged documents are written whole: finding columns to shred them into costs more than parsing them.
STAGED = {"spark.sql.variant.inferShreddingSchema": "false"}
#: Spark's switch for removing a query's shuffle files at its end, on all executors.
RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "ferrycraft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots and win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ferrycraft-"))
    return sc.getCheckpointDir()


_made: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drops, at its end, the tables that were staged inside: results must have been written or collected by then."""
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        del _made[before:]


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and pins the rows, so a lost executor re-reads files instead of re-running (and
    possibly re-ordering) the work above.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(**STAGED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Queries run inside give their shuffle files back when they end, not when the driver happens to collect its garbage."""
    was = spark.conf.get(RELEASED, None)
    spark.conf.set(RELEASED, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(RELEASED)
        else:
            spark.conf.set(RELEASED, was)


def settle(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what ``make`` returns; tables that it has staged on the way, and its shuffle files, are dropped."""
    with scratch(spark), released(spark):
        result = stage(make(), label)
        path = _made.pop()
    _made.append(path)
    return result


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a scan's rows out round-robin: for CPU-heavy work over files that make few splits.

    Always a shuffle, so call it only where the files are known to be few and the work to be heavy.
    """
    return scan.repartition(partitions or scan.sparkSession.sparkContext.defaultParallelism)
