"""Did the data arrive: counts, fingerprints, row differences, reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    MapType,
    NumericType,
    StructType,
    VariantType,
)

from .conform import one_pass


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of every table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(source: DataFrame, target: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Source against target counts per table: PASS, FAIL or ERROR.

    A table absent from one side counts as -1. ``errors``: table_name, issue of loads that raised.
    """
    s = source.select("table_name", F.col("row_count").alias("source_rows"))
    t = target.select("table_name", F.col("row_count").alias("target_rows"))
    both = s.join(t, "table_name", "full_outer").withColumns({
        "source_rows": F.coalesce("source_rows", F.lit(-1).cast("bigint")),
        "target_rows": F.coalesce("target_rows", F.lit(-1).cast("bigint")),
    })
    if errors is None:
        both = both.withColumn("issue", F.lit(None).cast("string"))
    else:
        both = both.join(errors.select("table_name", "issue"), "table_name", "left")
    match = F.col("source_rows") == F.col("target_rows")
    status = F.when(F.col("issue").isNotNull(), "ERROR").when(match, "PASS").otherwise("FAIL")
    return both.withColumn("matches", match).withColumn("status", status)


def _summary() -> list[Column]:
    passed = F.count_if(F.col("status") == "PASS")
    failed = F.count_if(F.col("status") != "PASS")
    return [
        F.count(F.lit(1)).alias("total_tables"), passed.alias("passed"), failed.alias("failed"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall"),
    ]


def load_summary(recon: DataFrame) -> DataFrame:
    """``total_tables, passed, failed, overall``."""
    return recon.agg(*_summary())


def migration_report(recon: DataFrame, views: DataFrame | None = None) -> DataFrame:
    """One nested row: summary, per-table results, views created / skipped / manual.

    The per-table list has one entry per migrated table.
    """
    entry = F.struct("table_name", "source_rows", "target_rows", "matches", "status", "issue")
    parts = recon.agg(F.struct(*_summary()).alias("summary"), F.sort_array(F.collect_list(entry)).alias("tables"))
    if views is not None:
        tally = views.agg(F.struct(*[
            F.count_if(F.col("status") == s).alias(s.lower()) for s in ("CREATED", "SKIPPED", "MANUAL")
        ]).alias("views"))
        parts = parts.unionByName(tally, allowMissingColumns=True).agg(*[
            F.first(c, ignorenulls=True).alias(c) for c in ("summary", "tables", "views")])
    return parts.select(F.current_timestamp().alias("generated_at"), "*")


def _canonical(c: Column, t: DataType) -> Column:
    """The value in a form that JSON shows in one way only: map entries in order, bytes in hexadecimal."""
    if isinstance(t, MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            value_text(e["key"], t.keyType).alias("key"), value_text(e["value"], t.valueType).alias("value"))))
    if isinstance(t, StructType):
        return F.when(c.isNotNull(), F.struct(*[_canonical(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda v: _canonical(v, t.elementType))
    return F.hex(c) if isinstance(t, BinaryType) else c


def value_text(c: Column, t: DataType) -> Column:
    """A value of any type as text, NULL for NULL."""
    if isinstance(t, VariantType):
        return F.to_json(c)
    if isinstance(t, (MapType, StructType, ArrayType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(_canonical(c, t).alias("v")), {"ignoreNullFields": "false"}))
    return _canonical(c, t).cast("string")


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as one text: each value behind its length, ``~`` for NULL, so no two rows look alike."""
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [value_text(F.col(f"`{name}`"), types[name]) for name in columns or df.columns]
    return F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")) for v in values])


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """60 bits of the MD5 of the row's text, which other engines can compute as well."""
    return F.conv(F.substring(F.md5(row_text(df, columns)), 1, 15), 16, 10).cast("bigint")


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """Aggregates that identify a table's content whatever the row order, for ``agg`` or ``observe``.

    The hash sum is a DECIMAL(38,0): it cannot overflow, and unlike XOR it sees duplicated rows.
    """
    out = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash(df).cast("decimal(38,0)")).alias("row_hash_sum"),
    ]
    for f in df.schema.fields:
        out.append(F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"nulls__{f.name}"))
    return out


def fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(*fingerprint_columns(df))


def observed_fingerprint(df: DataFrame, name: str = "fingerprint") -> tuple[DataFrame, Observation]:
    """``df`` that records its own fingerprint while it is being written; read it with ``Observation.get``."""
    seen = Observation(name)
    return df.observe(seen, *fingerprint_columns(df)), seen


# Digits of a limb of an exact sum: a sum of limbs stays exact in DECIMAL(38,0) for 10 ** 18 rows.
_LIMB = 19
# A number as binary floating point is summed by the decimal that prints it, where that has so many digits at most.
_FLOAT_TYPE = DecimalType(38, 18)


def _limbs(c: Column, t: DecimalType) -> list[Column]:
    """The whole part above and below 10 ** 19, then the digits after the point in steps of 19, all but the first >= 0."""
    base = F.lit(str(10 ** _LIMB)).cast("decimal(20,0)")
    whole = F.floor(c).cast("decimal(38,0)")
    below = F.pmod(whole, base).cast("decimal(19,0)")
    out = [((whole - below) / base).cast("decimal(20,0)"), below]
    if t.scale:
        # 1.xxx prints without an exponent, so that the digits can be read off
        one = F.lit(1).cast("decimal(1,0)")
        digits = F.rpad(F.substring((F.pmod(c, one) + one).cast("string"), 3, t.scale), 2 * _LIMB, "0")
        out += [F.substring(digits, 1, _LIMB).cast("decimal(19,0)"), F.substring(digits, 1 + _LIMB, _LIMB).cast("decimal(19,0)")]
    return out


def _limb_sums(c: Column, t: DecimalType) -> list[Column]:
    """Aggregates: the sums of a number's limbs.

    Where the type leaves room, the whole part and what is behind the point are summed as they are, without splitting
    digits of each row: exact for 10 ** 10 rows.
    """
    if t.precision - t.scale > 20 or t.scale > 18:
        return [F.sum(limb) for limb in _limbs(c, t)]
    whole = F.floor(c).cast("decimal(20,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    if not t.scale:
        return [zero, F.sum(whole)]
    after = F.sum((c - whole).cast(DecimalType(t.scale + 1, t.scale)))
    base = F.lit(str(10 ** _LIMB)).cast("decimal(20,0)")
    return [zero, F.sum(whole), (after * base).cast("decimal(38,0)"), zero]


def _sum_text(sums: list[Column], scale: int) -> Column:
    """Sums of limbs as the digits of one number, carried and with its sign, at ``scale`` digits after the point."""
    base = F.lit(str(10 ** _LIMB)).cast("decimal(20,0)")
    limbs = F.array(*[F.coalesce(s, F.lit(0)).cast("decimal(38,0)") for s in sums])

    def step(acc: Column, limb: Column) -> Column:
        limb = limb + acc["carry"]
        low = F.pmod(limb, base)
        return F.struct(((limb - low) / base).cast("decimal(38,0)").alias("carry"), F.concat(
            F.lpad(low.cast("decimal(19,0)").cast("string"), _LIMB, "0"), acc["digits"]).alias("digits"))

    carried = lambda x: F.aggregate(F.reverse(x), F.struct(
        F.lit(0).cast("decimal(38,0)").alias("carry"), F.lit("").alias("digits")), step)
    sign = F.when(carried(limbs)["carry"] < 0, -1).otherwise(1)
    plain = F.transform(F.array(sign), lambda s: F.struct(s.alias("sign"), carried(F.transform(
        limbs, lambda x: (x * s).cast("decimal(38,0)"))).alias("sum")))[0]
    digits = F.concat(plain["sum"]["carry"].cast("string"), plain["sum"]["digits"])
    after = 2 * _LIMB if scale else 0
    text = F.regexp_replace(F.left(digits, F.length(digits) - after), "^0+(?=.)", "")
    if scale:
        text = F.concat(text, F.lit("."), F.substring(F.right(digits, F.lit(after)), 1, scale))
    return F.concat(F.when(plain["sign"] < 0, "-").otherwise(""), text)


def exact_value(c: Column, t: DataType) -> tuple[Column, DecimalType]:
    """A number as a DECIMAL of its own scale, NULL where none is equal to it.

    Binary floating point takes the decimal that it prints as; NaN, infinities and values that need over 18 digits
    after the point or 20 before have none, nor have the digits of a DECIMAL beyond the 36th after the point.
    """
    if isinstance(t, (FloatType, DoubleType)):
        own, value = _FLOAT_TYPE, c.cast("string").try_cast(_FLOAT_TYPE)
        value = F.when(value.cast(t) == c, value)
    elif isinstance(t, DecimalType):
        own = DecimalType(38, 36) if t.scale > 36 else t
        value = c if own is t else F.when(c.try_cast(own) == c, c.try_cast(own))
    else:
        own, value = DecimalType(20, 0), c.cast("decimal(20,0)")
    return value, own


def exact_sum(c: Column, t: DataType) -> tuple[Column, Column]:
    """Aggregates: the exact sum of a number column as text at the column's own scale, and the values left out of it.

    A DECIMAL of any precision is summed whole, without overflow; see ``exact_value`` for what is left out and
    counted. NULL where there is no value to sum.
    """
    value, own = exact_value(c, t)
    sums = _limb_sums(value, own)
    return F.when(F.count(value) > 0, _sum_text(sums, own.scale)), F.count_if(c.isNotNull() & value.isNull())


def column_totals(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, exact sum of numbers as text, values left out of it, estimated distinct values, smallest
    and largest value as text. Nested columns are counted only.

    The estimate is within two percent or so; it comes from a sketch, see ``distinct_sketches``.
    """
    structs = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        number, flat = isinstance(t, NumericType), not isinstance(t, (ArrayType, MapType, StructType, VariantType))
        total, lost = exact_sum(c, t) if number else (F.lit(None).cast("string"), F.lit(0).cast("bigint"))
        structs.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("total_rows"), F.count_if(c.isNull()).alias("nulls"),
            total.alias("exact_sum"), lost.alias("unsummed"),
            F.hll_sketch_estimate(F.hll_sketch_agg(value_text(c, t), F.lit(SKETCH_BITS))).alias("distinct_estimate"),
            (value_text(F.min(c), t) if flat else F.lit(None).cast("string")).alias("smallest"),
            (value_text(F.max(c), t) if flat else F.lit(None).cast("string")).alias("largest")))
    return one_pass(df, structs, "column_name string, total_rows bigint, nulls bigint, exact_sum string, unsummed bigint, "
                    "distinct_estimate bigint, smallest string, largest string")


# Sketches of 2 ** 14 registers: a relative error of about one percent, 8 KB at most.
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame) -> DataFrame:
    """``column_name, rows, sketch``: what to keep of a batch or a partition, so that distinct counts can be merged."""
    return one_pass(df, [F.struct(
        F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(value_text(F.col(f"`{f.name}`"), f.dataType), F.lit(SKETCH_BITS)).alias("sketch"))
        for f in df.schema.fields], "column_name string, rows bigint, sketch binary")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """``column_name, rows, distinct_estimate`` over all batches whose sketches are given; no batch is read again."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def reconcile_arrays(parents: DataFrame, key: str, array: str, children: DataFrame, child_key: str) -> DataFrame:
    """Parents whose array size differs from their number of child rows.

    Sizes and child counts meet as signed partial sums in one grouping, so neither side needs a join and a
    parent with very many children is combined on the map side.
    """
    zero = F.lit(0).cast("bigint")
    sizes = parents.select(F.col(key).alias("parent_key"), F.coalesce(
        F.when(F.col(array).isNotNull(), F.size(array)), F.lit(0)).cast("bigint").alias("elements"), zero.alias("rows"))
    rows = children.select(F.col(child_key).alias("parent_key"), zero.alias("elements"),
                           F.lit(1).cast("bigint").alias("rows"))
    return (sizes.unionByName(rows).groupBy("parent_key")
            .agg(F.sum("elements").alias("elements"), F.sum("rows").alias("child_rows"))
            .where(F.col("elements") != F.col("child_rows")))


def diff_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side: all columns, ``left_extra`` and ``right_extra``.

    Equal rows cancel as +1 and -1 in one grouping over whole rows (nulls equal), combined on the map side.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    signed = left.withColumn("__sign", F.lit(1)).unionByName(right.select(*columns).withColumn("__sign", F.lit(-1)))
    net = signed.groupBy(*columns).agg(F.sum("__sign").alias("__net")).where(F.col("__net") != 0)
    return net.select(*columns, F.greatest("__net", F.lit(0)).alias("left_extra"),
                      F.greatest(-F.col("__net"), F.lit(0)).alias("right_extra"))


def diff_by_key(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys missing on a side or with changed columns: ``keys``, ``change``, ``changed_columns``."""
    keys = list(keys)
    values = [c for c in left.columns if c not in keys]
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    tag = lambda df, side: df.select(*quoted(keys), F.struct(*quoted(values)).alias(side))
    both = tag(left, "l").join(tag(right, "r"), keys, "full_outer")
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")), F.lit(c)) for c in values]))
    change = F.when(F.col("r").isNull(), "removed").when(F.col("l").isNull(), "added").when(
        F.size(changed) > 0, "changed")
    return both.select(*quoted(keys), change.alias("change"), F.when(change == "changed", changed).alias(
        "changed_columns")).where(F.col("change").isNotNull())


def load_metrics(rows: int, seconds: float) -> dict[str, float]:
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds > 0 else float(rows)}
