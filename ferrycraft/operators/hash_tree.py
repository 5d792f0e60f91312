"""Differences of two large tables, found through a tree of hashes over key ranges.

A level splits the ranges of the level above into parts and compares the parts' row counts and hash sums in one grouping,
which combines before the shuffle. Only ranges that differ are opened: their bounds reach the scan as filters, so files
that are clustered by the key are skipped, and other rows are dropped before anything is hashed. Rows themselves meet
only for the leaves that differ.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, MapType, StructField, TimestampNTZType, TimestampType, VariantType

from ..session import stage
from .reconcile import diff_tables, value_text

#: Parts of a range on the next level, rows a leaf is meant to hold, and intervals that a scan's filter lists at most.
FANOUT, LEAF_ROWS, INTERVALS = 64, 1 << 16, 64
#: Parts that come to the driver, coarsened to as many, to make those intervals.
LISTED = 4096


@dataclass(frozen=True)
class TreeDiff:
    """``cells``: keys, ``change`` (added, removed, changed), ``column_name``, ``left_value``, ``right_value`` as text.
    ``levels``: level, part_width, parts, differing, rows_read."""

    cells: DataFrame
    levels: DataFrame


def _position(field: StructField, keys: Sequence[str]) -> tuple[Column, object]:
    """Where a row stands in key order as a long, and the function that gives a position's key for a filter.

    Integers, dates and timestamps keep their order; other keys are placed by their hash, without a filter.
    """
    key = F.col(f"`{field.name}`")
    if isinstance(field.dataType, IntegralType):
        return key.cast("bigint"), lambda at: F.lit(at)
    if isinstance(field.dataType, DateType):
        return F.unix_date(key).cast("bigint"), lambda at: F.date_from_unix_date(F.lit(at))
    if isinstance(field.dataType, TimestampType):
        return F.unix_micros(key), lambda at: F.timestamp_micros(F.lit(at))
    if isinstance(field.dataType, TimestampNTZType):
        return F.unix_micros(key.cast("timestamp")), None
    return F.when(key.isNotNull(), F.xxhash64(*[F.col(f"`{k}`") for k in keys])), None


def content_hash(df: DataFrame) -> Column:
    """A 64-bit hash of the row; NULLs count by their place, maps and variants by their text."""
    values = [value_text(F.col(f"`{f.name}`"), f.dataType) if isinstance(f.dataType, (MapType, VariantType))
              else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*values, F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values]))


def merged(parts: list[int], most: int = INTERVALS) -> list[tuple[int, int]]:
    """Sorted numbers as ``most`` half-open intervals at most: the widest gaps stay out."""
    gaps = sorted(range(1, len(parts)), key=lambda i: parts[i - 1] - parts[i])[:most - 1]
    cuts = [0, *sorted(i for i in gaps if parts[i] - parts[i - 1] > 1), len(parts)]
    return [(parts[a], parts[b - 1] + 1) for a, b in zip(cuts, cuts[1:])] if parts else []


def _intervals(parts: DataFrame, total: int) -> list[tuple[int, int]]:
    """The parts as intervals; coarsened, so that no more than ``LISTED`` numbers come to the driver."""
    coarse = -(-total // LISTED)
    found = sorted(r[0] for r in parts.where("part >= 0").selectExpr(f"part div {coarse} AS p").distinct().collect())
    return [(a * coarse, b * coarse) for a, b in merged(found)]


def tree_diff(left: DataFrame, right: DataFrame, keys: Iterable[str], fanout: int = FANOUT,
              leaf_rows: int = LEAF_ROWS) -> TreeDiff:
    """Cells that differ between two tables of the same columns, and what each level of the tree read.

    The first key ranges the tree. Rows with equal keys are paired in the order of their content; a table need not
    have unique keys, and NULL keys are a range of their own. Right values are cast to the left columns' types.
    """
    keys, columns = list(keys), left.columns
    right = right.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in left.schema.fields])
    at, key_of = _position(left.schema[keys[0]], keys)
    spans = [df.agg(F.count(F.lit(1)), F.min(at), F.max(at)).first() for df in (left, right)]
    rows = max(s[0] for s in spans)
    low, high = (f([s[i] for s in spans if s[i] is not None], default=0) for f, i in ((min, 1), (max, 2)))
    shift = 1 if high - low >= 1 << 62 else 0  # so that differences of positions stay within a long
    low, high = low >> shift, high >> shift
    leaves = max(1, -(-rows // leaf_rows))
    leaf = max(1, -(-(high - low + 1) // leaves))
    depth = next(d for d in range(1, 64) if fanout ** d >= leaves)

    def placed(df: DataFrame, width: int, opened: tuple[DataFrame, int] | None, intervals: list) -> DataFrame:
        """``part``, ``row`` and ``hash`` of the rows in opened ranges."""
        if intervals and key_of:
            key = F.col(f"`{keys[0]}`")
            ranges = [(key >= key_of((low + a * opened[1]) << shift)) & (key <= key_of(min(
                ((low + b * opened[1]) << shift) - 1, (1 << 63) - 1))) for a, b in intervals]
            df = df.where(reduce(lambda x, y: x | y, ranges) | key.isNull())
        rows = df.select(F.shiftright(at, shift).alias("at"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                         content_hash(df).alias("hash"))
        part = lambda w: F.coalesce(F.expr(f"(at - {low}L) div {w}L"), F.lit(-1))
        rows = rows.select(part(width).alias("part"), *([part(opened[1]).alias("above")] if opened else []), "row", "hash")
        if opened is None:
            return rows
        return rows.join(opened[0].select(F.col("part").alias("above")), "above", "left_semi").drop("above")

    opened, intervals, levels, parts = None, [], [], None
    for level in range(depth):
        width = min(leaf * fanout ** (depth - 1 - level), high - low + 1)
        signed = [placed(df, width, opened, intervals).select(
            "part", (F.col("hash").cast("decimal(38,0)") * sign).alias("hash"), F.lit(max(sign, 0)).alias("l"),
            F.lit(max(-sign, 0)).alias("r")) for df, sign in ((left, 1), (right, -1))]
        sums = stage(signed[0].union(signed[1]).groupBy("part").agg(
            F.sum("hash").alias("net"), F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows")), "tree_level")
        parts = sums.where("net <> 0 OR left_rows <> right_rows")
        read = sums.agg(F.count(F.lit(1)), F.count_if(F.expr("net <> 0 OR left_rows <> right_rows")),
                        F.coalesce(F.sum(F.col("left_rows") + F.col("right_rows")), F.lit(0))).first()
        levels.append((level, width, *read))
        opened = parts, width
        intervals = _intervals(parts, -(-(high - low + 1) // width)) if read[1] else []
        if not read[1]:
            break
    session = left.sparkSession
    report = session.createDataFrame(
        levels, "level int, part_width bigint, parts bigint, differing bigint, rows_read bigint")
    if not levels[-1][3]:
        return TreeDiff(_cells(left.limit(0), right.limit(0), keys), report)
    hit = [placed(df, leaf, opened, intervals).select("row.*") for df in (left, right)]
    return TreeDiff(_cells(*hit, keys), report)


def _cells(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equal rows cancel; what is left is paired by key, the first with the first, and told cell by cell."""
    columns, types = left.columns, {f.name: f.dataType for f in left.schema.fields}
    net = stage(diff_tables(left, right), "differing_rows")
    key = [F.col(f"row.`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]

    def side(extra: str) -> DataFrame:
        rows = net.where(F.col(extra) > 0).select(
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), content_hash(net.select(
                *[F.col(f"`{c}`") for c in columns])).alias("hash"), F.explode(F.array_repeat(F.lit(1), F.col(extra).cast("int"))))
        rows = rows.select(*key, "row", "hash")
        nth = F.row_number().over(Window.partitionBy(*[f"k{i}" for i in range(len(keys))]).orderBy("hash"))
        return rows.select(*[f"k{i}" for i in range(len(keys))], nth.alias("nth"), "row")

    l, r = side("left_extra").alias("l"), side("right_extra").alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*(f"k{i}" for i in range(len(keys))), "nth"]]
    both = l.join(r, same, "full_outer")
    text = lambda s, c: value_text(F.col(f"{s}.row.`{c}`"), types[c])
    cells = F.filter(F.array(*[
        F.when(~text("l", c).eqNullSafe(text("r", c)), F.struct(F.lit(c).alias("column_name"), text("l", c).alias("left_value"),
                                                                text("r", c).alias("right_value"))) for c in columns]),
        lambda x: x.isNotNull())
    change = F.when(F.col("r.row").isNull(), "removed").when(F.col("l.row").isNull(), "added").otherwise("changed")
    told = both.select(*[F.coalesce(F.col(f"l.k{i}"), F.col(f"r.k{i}")).alias(k) for i, k in enumerate(keys)],
                       change.alias("change"), F.when(change == "changed", cells).alias("cells"))
    return told.select(*[F.col(f"`{k}`") for k in keys], "change", F.explode_outer("cells").alias("c")).select(
        *[F.col(f"`{k}`") for k in keys], "change", "c.*")
