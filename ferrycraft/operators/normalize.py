"""Documents and wide tables to normal form: child tables, surrogate keys, entities, exact money."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.doc_types import value_at
from ..session import stage
from .conform import one_pass
from .reconcile import diff_tables, exact_sum, exact_value


def document_array(doc: Column, steps: list[str]) -> Column:
    """Array of VARIANT at a path of a document; NULL when it is missing or no array."""
    return value_at(doc, steps, "array<variant>")


def json_array(text: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")


def explode_child(df: DataFrame, key: str, elements: Column, value_type: str = "string",
                  fields: Mapping[str, tuple[list[str], str]] | None = None, value: str = "value",
                  distinct: bool = False, position: str = "pos") -> DataFrame:
    """Child table of an array column: one row per element with the parent key and 0-based position.

    Scalars give one ``value`` column. With ``fields`` (name to path and type), objects give one column each.
    ``distinct`` keeps one row per (key, value) and no position, as a junction table's primary key wants; repeats
    are first dropped inside the row, so only parents stored in several rows meet in the shuffle.
    """
    if fields:
        items = df.select(F.col(key), F.posexplode(elements).alias(position, "__e"))
        return items.select(key, position, *[
            value_at(F.col("__e"), steps, t).alias(name) for name, (steps, t) in fields.items()])
    typed = F.transform(elements, lambda e: F.try_variant_get(e, "$", value_type))
    if distinct:
        return df.select(F.col(key), F.explode(F.array_distinct(typed)).alias(value)).where(
            F.col(value).isNotNull()).dropDuplicates([key, value])
    return df.select(F.col(key), F.posexplode(typed).alias(position, value))


def assign_surrogate_keys(df: DataFrame, natural_key: Sequence[str], name: str = "id", start: int = 1,
                          partitions: int | None = None) -> DataFrame:
    """Dense integer keys in natural-key order, without sorting the table in one task.

    The rows are range-partitioned and sorted by the (unique) natural key and written once with their position;
    the offset of each partition is the running total of the sizes before it. Range bounds are sampled, so
    the written table, not a re-run, is what both steps read.
    """
    spark = df.sparkSession
    keys, own = ([F.col(f"`{k}`") for k in names] for names in (natural_key, df.columns))
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    mid = F.monotonically_increasing_id()
    numbered = ranged.sortWithinPartitions(*keys).withColumn("__mid", mid).select(
        *own,
        F.shiftright("__mid", 33).cast("int").alias("__part"),
        F.col("__mid").bitwiseAND((1 << 33) - 1).alias("__pos"),
    )
    written = stage(numbered, "surrogate")
    # One row per partition: the only thing that comes to the driver.
    sizes = written.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    offsets, total = [], start
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    lookup = spark.createDataFrame(offsets, "__part int, __offset bigint")
    return written.join(F.broadcast(lookup), "__part").select(
        (F.col("__offset") + F.col("__pos")).alias(name), *own)


def extend_surrogate_keys(df: DataFrame, natural_key: Sequence[str], path: str, batch: int, name: str = "id",
                          start: int = 1, partitions: int | None = None) -> DataFrame:
    """The rows of a batch with the surrogate keys of a dictionary that is kept at ``path`` from batch to batch.

    Natural keys of earlier batches keep their number; new ones continue it without a gap, in key order. A batch is a
    folder of its own, so one that is run again replaces its own numbers by the same ones, and one that comes
    before a batch already numbered is refused. A natural key with a NULL part gets none.
    """
    spark, keys = df.sparkSession, list(natural_key)
    named = [F.col(f"`{k}`") for k in keys]
    if batch < 0:
        raise ValueError("batches count from 0")
    known = key_dictionary(spark, path)
    if known is not None:
        numbered = known.agg(F.max("batch")).first()[0]
        if numbered is not None and numbered > batch:
            raise ValueError(f"batch {numbered} is numbered already; batch {batch} can't come after it")
        known = known.where(F.col("batch") < batch).drop("batch")
    new = df.select(*named).where(reduce(lambda a, b: a & b, [k.isNotNull() for k in named])).distinct()
    first = start
    if known is not None:
        new = new.join(known.select(*named), keys, "left_anti")
        top = known.agg(F.max(F.col(f"`{name}`"))).first()[0]
        first = start if top is None else top + 1
    added = assign_surrogate_keys(new, keys, name, first, partitions)
    added.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return resolve_keys(df, keys, key_dictionary(spark, path), keys, name)


def key_dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    """Natural keys, surrogate key and ``batch`` of a kept dictionary; ``None`` before its first batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.parquet(path)


def resolve_keys(child: DataFrame, columns: Sequence[str], parent: DataFrame, natural_key: Sequence[str],
                 surrogate: str, alias: str | None = None) -> DataFrame:
    """Add the parent's surrogate key; NULL where the natural key has no parent.

    The many-row side is on the left of a left join, where AQE can split a hot key.
    """
    lookup = parent.select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(natural_key)],
        F.col(f"`{surrogate}`").alias(alias or surrogate))
    condition = [F.col(f"`{c}`") == F.col(f"__k{i}") for i, c in enumerate(columns)]
    return child.join(lookup, condition, "left").drop(*[f"__k{i}" for i in range(len(columns))])


def extract_entity(df: DataFrame, attributes: Sequence[str], name: str,
                   partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Move a repeated group of columns to its own table: (entity with key ``name``, ``df`` holding the key)."""
    attributes = list(attributes)
    entity = assign_surrogate_keys(df.select(*attributes).distinct(), attributes, name, partitions=partitions)
    lookup = entity.select(name, *[F.col(f"`{a}`").alias(f"__a{i}") for i, a in enumerate(attributes)])
    same = [F.col(f"`{a}`").eqNullSafe(F.col(f"__a{i}")) for i, a in enumerate(attributes)]
    rest = [c for c in df.columns if c not in attributes]
    return entity, df.join(lookup, same, "left").select(*rest, name)


def to_decimal(df: DataFrame, columns: Iterable[str], precision: int = 12, scale: int = 2) -> DataFrame:
    """Columns at exact DECIMAL(p,s); a value too large becomes NULL (see ``money_totals``)."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(f"decimal({precision},{scale})") for c in columns})


def money_totals(df: DataFrame, columns: Iterable[str], precision: int = 12, scale: int = 2) -> DataFrame:
    """Per column: rows whose value changes or is lost at DECIMAL(p,s), and both exact sums as text, each at its scale.

    ``unsummed`` counts values that have no exact decimal of the column's own scale (see ``exact_value``).
    """
    types, structs = {f.name: f.dataType for f in df.schema.fields}, []
    for c in columns:
        column, kind = F.col(f"`{c}`"), DecimalType(precision, scale)
        exact, _ = exact_value(column, types[c])
        money = column.try_cast(kind)
        before, unsummed = exact_sum(column, types[c])
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(money != exact).alias("changed"),
            F.count_if(column.isNotNull() & money.isNull()).alias("lost"),
            before.alias("sum_before"), exact_sum(money, kind)[0].alias("sum_after"), unsummed.alias("unsummed")))
    return one_pass(df, structs, "column_name string, changed bigint, lost bigint, sum_before string, sum_after string, "
                    "unsummed bigint")


def dual_read_diff(documents: DataFrame, key: str, elements: Column, fields: Mapping[str, tuple[list[str], str]],
                   children: DataFrame, position: str = "pos") -> DataFrame:
    """Elements of the document array against the child table, row by row.

    The array is exploded instead of re-nesting the children, so no parent's rows are gathered in one place.
    """
    old = explode_child(documents, key, elements, fields=fields, position=position)
    return diff_tables(old, children.select(*old.columns))
