"""Rows to the mapped target types, and an audit of what would not fit."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sql_types import TEXT_CAST_TYPES, ColumnSpec
from ..functions.text import normalize_text

_TEXT = ("char", "nchar", "varchar", "nvarchar", "text", "ntext") + TEXT_CAST_TYPES

# Ranges of the integer types, and what their text looks like; leading zeros don't count as digits.
_RANGES = {"smallint": (-2**15, 2**15 - 1), "int": (-2**31, 2**31 - 1), "bigint": (-2**63, 2**63 - 1)}
_INTEGER_TEXT = r"^\s*[+-]?0*[0-9]{1,19}\s*$"
_NUMBER_TEXT = r"(?i)^\s*[+-]?(inf(inity)?|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)[fd]?\s*$"
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def fit(value: Column, source_type: str, target: str) -> Column:
    """The value as ``target``, or NULL.

    A failed ``try_cast`` to a number raises and catches an exception inside Spark, which is slow when many
    rows fail; a range or pattern test keeps those rows away from it.
    """
    number = source_type in _NUMBERS or source_type.startswith("decimal")
    if number and target in _RANGES:
        low, high = _RANGES[target]
        return F.when(value.between(low, high), value.try_cast(target))
    if source_type == "string" and target in _RANGES:
        return F.when(value.rlike(_INTEGER_TEXT), value.try_cast(target))
    if source_type == "string" and (target in ("float", "double") or target.startswith("decimal")):
        return F.when(value.rlike(_NUMBER_TEXT), value.try_cast(target))
    return value.try_cast(target)


def conformed(spec: ColumnSpec, source_type: str, profile: str, normalize: bool = True) -> Column:
    """One column at its target type; a value that does not fit becomes NULL."""
    c = F.col(f"`{spec.name}`")
    if spec.base in _TEXT:
        text = c.cast("string")
        return normalize_text(text) if normalize else text
    target = spec.spark_type(profile)
    if target == "binary":
        return c if source_type == "binary" else c.cast("string").cast("binary")
    if source_type == "binary" and target.startswith("decimal"):
        return F.conv(F.hex(c), 16, 10).try_cast(target)
    if target != "boolean":
        return fit(c, source_type, target)
    if source_type in ("boolean", "string"):
        value = c.try_cast("boolean")
    else:
        value = c != 0
    return value.cast("int") if profile == "mysql" else value


def conform(df: DataFrame, specs: Iterable[ColumnSpec], profile: str = "pg", normalize: bool = True) -> DataFrame:
    """All columns in one projection, lower-case names, catalogue order."""
    types = dict(df.dtypes)
    return df.select(*[conformed(s, types[s.name], profile, normalize).alias(s.name.lower()) for s in specs])


def audit_conformance(df: DataFrame, specs: Iterable[ColumnSpec], profile: str = "pg") -> DataFrame:
    """Per column: ``present``, ``failed`` (no value of the target type), ``out_of_range``, ``too_long``, ``max_chars``.

    All columns share one scan and one aggregate row per task.
    """
    types = dict(df.dtypes)

    def metrics(s: ColumnSpec) -> Column:
        c, text = F.col(f"`{s.name}`"), F.col(f"`{s.name}`").cast("string")
        value = conformed(s, types[s.name], profile, normalize=False)
        failed = c.isNotNull() & value.isNull()
        bounds, pattern, limit = s.bounds(profile), s.pattern(profile), s.text_limit(profile)
        if pattern:
            failed = failed | ~text.rlike(pattern)
        outside = ~value.between(*bounds) if bounds else F.lit(False)
        long = F.char_length(text) > limit if limit else F.lit(False)
        is_text = s.spark_type(profile) == "string"
        return F.struct(
            F.lit(s.name.lower()).alias("column_name"),
            F.lit(s.spark_type(profile)).alias("stored_type"),
            F.count(c).alias("present"),
            F.count_if(failed).alias("failed"),
            F.count_if(outside).alias("out_of_range"),
            F.count_if(long).alias("too_long"),
            (F.max(F.char_length(text)) if is_text else F.lit(None).cast("int")).alias("max_chars"),
        )

    return one_pass(df, [metrics(s) for s in specs], "column_name string, stored_type string, present bigint, "
                    "failed bigint, out_of_range bigint, too_long bigint, max_chars int")


def one_pass(df: DataFrame, structs: list[Column], schema: str) -> DataFrame:
    """Aggregate structs in one scan, one output row each; without structs an empty frame of the schema."""
    if not structs:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(F.array(*structs).alias("m")).select(F.inline("m"))


def nonconforming_rows(df: DataFrame, specs: Iterable[ColumnSpec], profile: str = "pg") -> DataFrame:
    """The source rows with at least one value that does not fit, with the column names in ``bad_columns``."""
    types = dict(df.dtypes)
    bad = []
    for s in specs:
        c = F.col(f"`{s.name}`")
        value = conformed(s, types[s.name], profile, normalize=False)
        wrong = c.isNotNull() & value.isNull()
        if s.pattern(profile):
            wrong = wrong | ~c.cast("string").rlike(s.pattern(profile))
        if s.bounds(profile):
            wrong = wrong | ~value.between(*s.bounds(profile))
        if s.text_limit(profile):
            wrong = wrong | (F.char_length(c.cast("string")) > s.text_limit(profile))
        bad.append(F.when(wrong, F.lit(s.name.lower())))
    return df.withColumn("bad_columns", F.array_compact(F.array(*bad))).where(F.size("bad_columns") > 0)


def target_bool_as_int(flag: Column) -> Column:
    return flag.cast("int")


def apply_defaults(df: DataFrame, defaults: dict[str, Column], missing: dict[str, Column]) -> DataFrame:
    """Fill a column where its field was missing; explicit nulls stay (``missing``: column to condition)."""
    return df.withColumns({
        c: F.when(missing[c], value).otherwise(F.col(f"`{c}`")) for c, value in defaults.items()
    })
