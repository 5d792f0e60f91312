"""Documents to rows and back: flattening, schema inference, projection."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    MapType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..functions import doc_types as dt
from ..functions.text import target_column
from ..session import stage
from .conform import one_pass

#: Shapes and leaf paths of a collection up to which documents are read by path. More of them are opened level by level.
SHAPES, PATHS = 1000, 256


def parse_documents(lines: DataFrame, text: str = "value", doc: str = "doc") -> DataFrame:
    """Add the parsed document; malformed text gives NULL (see ``malformed_documents``)."""
    return lines.withColumn(doc, F.try_parse_json(F.col(text)))


def malformed_documents(lines: DataFrame, text: str = "value") -> DataFrame:
    return lines.where(F.col(text).isNotNull() & F.try_parse_json(F.col(text)).isNull())


def document_depth(docs: DataFrame, doc: str = "doc") -> int:
    """Levels of nesting of the deepest document, arrays included; one aggregate, one number to the driver."""
    shape = F.regexp_replace(F.schema_of_variant(F.col(doc)), "(`[^`]*`)+", "")
    step = lambda t: F.when(t == ">", -1).otherwise(1)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(
        F.regexp_extract_all(shape, F.lit("(OBJECT<|ARRAY<|>)"), F.lit(1)), start,
        lambda at, t: F.struct((at["now"] + step(t)).alias("now"), F.greatest(at["most"], at["now"] + step(t)).alias("most")))
    return docs.agg(F.max(deepest["most"])).first()[0] or 1


def level_bound(docs: DataFrame, doc: str = "doc", near: int = 16) -> int:
    """Levels that are enough to open every document: the most objects in one, or if these are many the depth."""
    shape = F.schema_of_variant(F.col(doc))
    objects = (F.length(shape) - F.length(F.replace(shape, F.lit("OBJECT<"), F.lit("")))) / len("OBJECT<")
    most = docs.agg(F.max(objects.cast("int"))).first()[0] or 1
    return most if most <= near else document_depth(docs, doc)


def document_shapes(docs: DataFrame, doc: str = "doc", most: int | None = None) -> list[StructType] | None:
    """The different shapes of the documents that are objects, or None where there are more than ``most`` (``SHAPES``).

    What types the leaves have is not told apart where that makes numbers of other precision.
    """
    found = _counted_shapes(docs, doc, most)
    return None if found is None else [shape for shape, _ in found]


def _counted_shapes(docs: DataFrame, doc: str, most: int | None = None,
                    decimals: bool = False) -> list[tuple[StructType, int]] | None:
    """The shapes with the number of their documents; only with ``decimals`` a decimal is told apart from a null."""
    numbers = r"(`[^`]*`|DECIMAL)(?:\([0-9]+,[0-9]+\))?" if decimals else r"(`[^`]*`)|DECIMAL\([0-9]+,[0-9]+\)"
    shape = F.regexp_replace(F.schema_of_variant(F.col(doc)), numbers, "$1")
    most = SHAPES if most is None else most
    found = docs.groupBy(shape.alias("shape")).count().limit(most + 1).collect()
    if len(found) > most:
        return None

    def ddl(token: re.Match) -> str:
        text = token[0]
        if text.startswith("OBJECT<"):
            return "STRUCT<"
        if text == "ARRAY<":  # of decimals
            return "ARRAY<VOID"
        return text if text.startswith("`") else ": VOID" if text == ": " else f"`{text}`"

    return [(StructType.fromDDL(re.sub(r"`(?:[^`]|``)*`|OBJECT<|ARRAY<(?=>)|: (?=[,>])|\w+(?=: )", ddl, r["shape"])), r["count"])
            for r in found if r["shape"] and r["shape"].startswith("OBJECT<")]


def _walked(shape: StructType) -> Iterator[tuple[tuple[str, ...], DataType, str]]:
    """Paths of a shape with the types there: a leaf (``value`` or ``wrapper``) or a document that is ``opened``."""
    todo: list[tuple[tuple[str, ...], DataType]] = [((), shape)]
    while todo:
        path, kind = todo.pop()
        wrapper = isinstance(kind, StructType) and path and any(n.startswith("$") for n in kind.names)
        nested = isinstance(kind, StructType) and not wrapper
        yield path, kind, "opened" if nested else "wrapper" if wrapper else "value"
        if nested:
            todo += [((*path, f.name), f.dataType) for f in kind.fields]


def _leaf_paths(shapes: list[StructType]) -> dict[tuple[str, ...], set[str]]:
    """What stands at each path of the shapes."""
    found: dict[tuple[str, ...], set[str]] = {}
    for shape in shapes:
        for path, _, what in _walked(shape):
            found.setdefault(path, set()).add(what)
    return found


def _told_leaves(spark: SparkSession, shapes: list[tuple[StructType, int]]) -> tuple[DataFrame, set[tuple[str, ...]]]:
    """Leaves that the shapes tell all of, ``(steps, value, shape, names, n)`` for ``n`` documents, and the other paths.

    Others are those with whole numbers, whose size no shape tells; their values must be read.
    """
    leaves = [(path, kind, n) for shape, n in shapes for path, kind, what in _walked(shape) if what != "opened"]
    others = {path for path, kind, _ in leaves
              if isinstance(kind, LongType) or isinstance(kind, StructType) and "$numberLong" in kind.names}
    told: Counter = Counter()
    for path, kind, n in leaves:
        if path not in others:
            names = tuple(kind.names) if isinstance(kind, StructType) else ()
            text = f"OBJECT<`{names[0]}`: " if names else kind.simpleString().upper()
            told[path, text, names] += n
    rows = [(list(path), text, list(names), n) for (path, text, names), n in told.items()]
    return spark.createDataFrame(rows, "steps array<string>, shape string, names array<string>, n bigint").withColumn(
        "value", F.lit(None).cast("variant")), others


def _leaves_by_path(docs: DataFrame, doc: str, keep: list[str], found: dict[tuple[str, ...], set[str]],
                    only: set[tuple[str, ...]] | None = None) -> DataFrame:
    """The leaves (``only`` those at some paths), each read by its path: no level is copied out of the document on the way."""
    source = F.col(f"`{doc}`")
    nested = lambda path: F.exists(F.array(dt.value_at(source, list(path), "map<string,variant>")), lambda m: m.isNotNull() & ~F.exists(
        F.map_keys(m), lambda k: F.startswith(k, F.lit("$"))))
    cells = []
    for path in sorted(p for p, kinds in found.items() if kinds - {"opened"} and (only is None or p in only)):
        # the same path may be a leaf in one document and opened in another, and lead through a wrapper in a third
        through = [p for p in (path[:n] for n in range(1, len(path))) if "wrapper" in found[p]]
        held = [nested(p) for p in through] + ([~nested(path)] if "opened" in found[path] else [])
        value = dt.value_at(source, list(path), "variant")
        cells += [F.array(*map(F.lit, path)), F.when(reduce(lambda a, b: a & b, held), value) if held else value]
    if not cells:
        return docs.select(*keep, F.array().cast("array<string>").alias("steps"), source.alias("value")).limit(0)
    return docs.select(*keep, F.stack(F.lit(len(cells) // 2), *cells).alias("steps", "value")).where("value IS NOT NULL")


def flatten_documents(docs: DataFrame, doc: str = "doc", keep: Iterable[str] = (),
                      max_depth: int | None = None) -> DataFrame:
    """One row per leaf: ``keep`` columns, ``steps`` (key path), ``value`` (VARIANT).

    Arrays and ``$`` wrappers are leaves; an empty nested document has none. The shapes of the documents are looked
    up first, so give documents that are parsed already, and then each leaf is read by its path. A collection of more
    shapes or paths than ``SHAPES`` and ``PATHS`` (data as field names) is opened level by level inside the row, as
    many levels as are measured; with ``max_depth`` nothing is looked up, and a deeper document fails the job
    rather than losing fields.
    """
    keep = list(keep)
    if max_depth is None:
        shapes = document_shapes(docs, doc)
        found = _leaf_paths(shapes) if shapes is not None else None
        if found is not None and len(found) <= PATHS:
            return _leaves_by_path(docs, doc, keep, found)
    return _leaves_by_level(docs, doc, keep, max_depth or level_bound(docs, doc))


def _leaves_by_level(docs: DataFrame, doc: str, keep: list[str], max_depth: int) -> DataFrame:
    """The leaves of any documents: each level of a document is opened out of the one above, inside the row."""
    def entries(fields: str, prefix: str) -> str:
        return (f"transform(map_entries({fields}), e -> struct({prefix}array(e.key)) as steps, e.value as value, "
                f"{dt.nested_object('e.value')} as fields))")

    def leaves(n: int) -> str:
        checked = f"level_{n}"
        if n == max_depth:
            checked = (f"transform({checked}, e -> if(size(e.fields) > 0, "
                       f"raise_error('document nested deeper than {max_depth} levels'), e))")
        return (f"coalesce(transform(filter({checked}, e -> e.fields is null), e -> struct(e.steps, e.value)), "
                "cast(array() as array<struct<steps: array<string>, value: variant>>))")

    opened = docs.select(*keep, F.expr(entries(dt.as_object(f"`{doc}`"), "concat(")).alias("level_1"))
    for n in range(2, max_depth + 1):
        above = f"level_{n - 1}"
        nested = f"transform(filter({above}, p -> p.fields is not null), p -> {entries('p.fields', 'concat(p.steps, ')})"
        # NULL, and no work at this and all deeper levels, where nothing is left to open.
        opened = opened.select("*", F.expr(
            f"case when exists({above}, p -> p.fields is not null) then flatten({nested}) end").alias(f"level_{n}"))
    levels = ", ".join(leaves(n) for n in range(1, max_depth + 1))
    return opened.select(*keep, F.expr(f"inline(concat({levels}))"))


def infer_schema(docs: DataFrame, doc: str = "doc", profile: str = "pg", sample: int | float | None = None,
                 seed: int = 0, max_depth: int | None = None, sample_by: str | None = None) -> DataFrame:
    """One row per field path: ``field, steps, rank, kinds, present, column_name, target_type``.

    Widening is the maximum of a rank, so it is combined on the map side and shuffles one row per field
    and task. The shapes of the documents tell the kinds and numbers of most leaves; where there are whole numbers the
    values are read, and all of them in collections of too many shapes (see ``flatten_documents``). ``sample``: a whole number reads the first documents, a fraction a random share,
    or with ``sample_by`` the share of keys with the lowest MD5, the same in every run and engine.
    """
    if isinstance(sample, float) and sample_by:
        digest = F.conv(F.left(F.md5(F.col(sample_by).cast("string")), F.lit(8)), 16, 10).cast("bigint")
        docs = docs.where(digest < int(sample * (1 << 32)))
    elif sample:
        picked = docs.sample(fraction=sample, seed=seed) if isinstance(sample, float) else docs.limit(sample)
        docs = stage(picked.select(doc), "sampled")  # looked at twice, so the same rows each time
    shapes = _counted_shapes(docs, doc, decimals=True) if max_depth is None else None
    found = _leaf_paths([shape for shape, _ in shapes]) if shapes is not None else {}
    told = None
    if shapes is not None and len(found) <= PATHS:
        told, others = _told_leaves(docs.sparkSession, shapes)
        leaves = _leaves_by_path(docs, doc, [], found, others)
    else:
        leaves = flatten_documents(docs, doc, max_depth=max_depth)

    def typed(rows: DataFrame, names: Column | None = None) -> DataFrame:
        kinds = rows.withColumn("kind", dt.value_kind(F.col("value"), F.col("shape"), names))
        return kinds.select("steps", dt.kind_rank(F.col("kind")).alias("rank"),
                            dt.kind_mask(F.col("kind"), F.col("shape")).alias("mask"), "n")

    cells = typed(leaves.withColumns({"shape": F.schema_of_variant(F.col("value")), "n": F.lit(1).cast("bigint")}))
    if told is not None:
        cells = cells.union(typed(told, F.col("names")))
    fields = cells.groupBy("steps").agg(
        F.max("rank").alias("rank"), F.bit_or("mask").alias("kinds"), F.sum("n").alias("present"),
    )
    named = fields.withColumn("field", F.array_join("steps", ".")).withColumn(
        "target_type", dt.target_type(F.col("rank"), profile))
    return target_names(named, order=("field", "steps"))


def target_names(fields: DataFrame, field: str = "field", order: Iterable[str] = ("field",)) -> DataFrame:
    """Add ``column_name`` and ``collides``: fields that fold to one name get ``__2``, ``__3``, … in field order."""
    name = target_column(F.col(field))
    same = Window.partitionBy(name)
    nth = F.row_number().over(same.orderBy(*order))
    shared = F.count(F.lit(1)).over(same) > 1
    return fields.withColumn("collides", shared).withColumn(
        "column_name", F.when(nth > 1, F.concat(name, F.lit("__"), nth)).otherwise(name))


def schema_rows(schema: DataFrame) -> list[Row]:
    """The inferred schema on the driver, ``_id`` first and the rest by field."""
    rows = sorted(schema.collect(), key=lambda r: (r["field"] != "_id", r["field"], r["steps"]))
    names = [r["column_name"] for r in rows]
    if len(set(names)) < len(names):
        raise ValueError(f"column names still collide: {sorted({n for n in names if names.count(n) > 1})}")
    return rows


def project_documents(docs: DataFrame, schema: DataFrame | list[Row], profile: str = "pg", doc: str = "doc",
                      keep: Iterable[str] = (), defaults: dict[str, Column] | None = None) -> DataFrame:
    """Documents as rows in schema order. ``defaults`` (by field) fill missing fields, never explicit nulls."""
    rows = schema_rows(schema) if isinstance(schema, DataFrame) else schema
    source, defaults = F.col(doc), defaults or {}
    columns = []
    for r in rows:
        value = dt.read_value(source, r["steps"], r["rank"], r["kinds"], profile)
        if r["field"] in defaults:
            value = F.when(dt.is_missing(source, r["steps"]), defaults[r["field"]]).otherwise(value)
        columns.append(value.alias(r["column_name"]))
    return docs.select(*keep, *columns)


def audit_projection(docs: DataFrame, schema: DataFrame | list[Row], profile: str = "pg",
                     doc: str = "doc") -> DataFrame:
    """Per field, values that are present and not null but do not fit the widened column type."""
    rows = schema_rows(schema) if isinstance(schema, DataFrame) else schema
    source = F.col(doc)
    counts = []
    for r in rows:
        raw = dt.value_at(source, r["steps"], "variant")
        held = raw.isNotNull() & ~F.is_variant_null(raw)
        lost = dt.read_value(source, r["steps"], r["rank"], r["kinds"], profile).isNull()
        counts.append(F.struct(
            F.lit(r["field"]).alias("field"), F.lit(r["target_type"]).alias("target_type"),
            F.count_if(held).alias("present"), F.count_if(held & lost).alias("lost"),
        ))
    return one_pass(docs, counts, "field string, target_type string, present bigint, lost bigint")


def _instant(value: Column, kind: DataType) -> Column:
    """ISO text in UTC whatever the session's zone; dates and zone-less timestamps are taken as UTC."""
    if isinstance(kind, TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        seconds = F.unix_micros(value).cast("decimal(20,0)") / F.lit(1000000)
        value = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    text = value.cast("timestamp_ntz").cast("string")
    fraction = F.rpad(F.regexp_extract(text, r"\.([0-9]+)$", 1), 6, "0")
    return F.concat(F.replace(F.regexp_replace(text, r"\.[0-9]+$", ""), F.lit(" "), F.lit("T")), F.lit("."), fraction, F.lit("Z"))


def _extended(value: Column, kind: DataType) -> Column:
    """The value with Extended JSON wrappers for what JSON cannot express, at any depth."""
    if isinstance(kind, DecimalType):
        return F.when(value.isNotNull(), F.struct(value.cast("string").alias("$numberDecimal")))
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.when(value.isNotNull(), F.struct(_instant(value, kind).alias("$date")))
    if isinstance(kind, (FloatType, DoubleType)):
        text = value.cast("string")
        special = text.isin("NaN", "Infinity", "-Infinity")
        return F.parse_json(F.when(special, F.concat(F.lit('{"$numberDouble":"'), text, F.lit('"}'))).otherwise(text))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[
            _extended(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda v: _extended(v, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, v: _extended(v, kind.valueType))
    if isinstance(kind, BinaryType):
        payload = F.struct(F.translate(F.base64(value), "\r\n", "").alias("base64"), F.lit("00").alias("subType"))
        return F.when(value.isNotNull(), F.struct(payload.alias("$binary")))
    return value


def rows_to_documents(df: DataFrame, doc: str = "doc", keep: Iterable[str] = ()) -> DataFrame:
    """Each row as one Extended JSON document string; field names are lower case and nulls are kept."""
    fields = [_extended(F.col(f"`{f.name}`"), f.dataType).alias(f.name.lower())
              for f in df.schema.fields]
    return df.select(*keep, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(doc))
