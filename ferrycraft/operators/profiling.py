"""Column profiles used to tighten target types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .conform import one_pass


def profile_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column: ``present``, ``populated`` (NOT NULL candidate), ``max_chars`` and the ``suggested`` text type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    structs = []
    for name in columns or df.columns:
        c = F.col(f"`{name}`")
        text = isinstance(types[name], StringType)
        longest = F.max(F.char_length(c)) if text else F.lit(None).cast("int")
        structs.append(F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("total"),
            F.count(c).alias("present"),
            (F.count(c) == F.count(F.lit(1))).alias("populated"),
            longest.alias("max_chars"),
        ))
    return one_pass(df, structs, "column_name string, total bigint, present bigint, populated boolean, max_chars int").withColumn(
        "suggested", F.when(F.col("max_chars").isNotNull(), F.format_string("VARCHAR(%d)", "max_chars")))


def distinct_estimates(df: DataFrame, columns: Iterable[str], max_values: int = 20, rsd: float = 0.05) -> DataFrame:
    """``column_name, estimate, may_be_small`` of every column, from one scan. The margin covers the estimate's error."""
    return one_pass(df, [
        F.struct(F.lit(c).alias("column_name"), F.approx_count_distinct(f"`{c}`", rsd).alias("estimate"))
        for c in columns
    ], "column_name string, estimate bigint").withColumn(
        "may_be_small", F.col("estimate") <= max_values * (1 + 4 * rsd) + 1)


def profile_domains(df: DataFrame, columns: Iterable[str], max_values: int = 20, rsd: float = 0.05) -> DataFrame:
    """Values and counts of the columns with few distinct values (ENUM candidates).

    The columns that ``distinct_estimates`` flags as small are counted exactly, all in one pass, and those over
    the limit drop out; that report says which columns were not counted and why.
    """
    small = [r["column_name"] for r in distinct_estimates(df, columns, max_values, rsd).collect() if r["may_be_small"]]
    if not small:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n bigint")
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in small
    ])))
    counts = pairs.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # At most len(small) * (max_values + margin) rows reach this join.
    sizes = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") <= max_values)
    return counts.join(sizes, "column_name", "left_semi")
