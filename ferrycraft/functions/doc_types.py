"""Types of document values: kinds, the widening order, and how a column reads each kind back.

A document is a VARIANT column. Values that JSON cannot express arrive in Extended JSON wrappers such as
``{"$oid": …}``; a wrapper is a value, not a nested document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of value, as bit positions of a column's ``kinds`` mask.
VOID, BOOLEAN, INT, BIGINT, DOUBLE, DECIMAL, DATE, DATETIME, OID, JSON, BINARY, TEXT, WRAPPED = range(13)

# Widening rank of each kind. Two kinds in one column give the higher rank; text (and an
# explicit null, which is text) absorbs everything.
RANK = {
    BOOLEAN: 1, INT: 2, BIGINT: 3, DOUBLE: 4, DECIMAL: 5, DATE: 6, DATETIME: 7, OID: 8,
    JSON: 11, BINARY: 12, TEXT: 99, VOID: 99,
}
# Target type name of each rank.
TARGET_TYPES = {
    "mysql": {
        1: "TINYINT(1)", 2: "INT", 3: "BIGINT", 4: "DOUBLE", 5: "DECIMAL(38,18)", 6: "DATE",
        7: "DATETIME(6)", 8: "CHAR(24)", 11: "JSON", 12: "LONGBLOB", 99: "LONGTEXT",
    },
    "pg": {
        1: "BOOLEAN", 2: "INTEGER", 3: "BIGINT", 4: "DOUBLE PRECISION", 5: "NUMERIC(38,18)", 6: "DATE",
        7: "TIMESTAMPTZ", 8: "CHAR(24)", 11: "JSONB", 12: "BYTEA", 99: "TEXT",
    },
}
STORED_TYPES = {
    1: "boolean", 2: "int", 3: "bigint", 4: "double", 5: "decimal(38,18)", 6: "date", 7: "timestamp",
    8: "string", 11: "string", 12: "binary", 99: "string",
}


def as_object(value: str) -> str:
    """SQL: the value's fields when it is an object, else NULL."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def nested_object(value: str) -> str:
    """SQL: the value's fields when it is a nested document (an object without a ``$`` key), else NULL."""
    plain = "m -> not exists(map_keys(m), k -> startswith(k, '$'))"
    return f"get(filter(array({as_object(value)}), {plain}), 0)"


def _int_kind(value: Column, path: str) -> Column:
    number = F.try_variant_get(value, path, "bigint")
    return F.when(number.between(-2147483648, 2147483647), INT).otherwise(BIGINT)


def value_kind(value: Column, shape: Column, names: Column | None = None) -> Column:
    """Kind of one value; ``shape`` is ``schema_of_variant(value)``, passed in so it is computed once.

    A JSON number with a fraction parses as an exact decimal but stands for a double. With the ``names`` of an object's
    fields the value is looked at for the size of a whole number only.
    """
    if names is None:
        names = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))

    def wrapper(key: str, beside: str | None = None) -> Column:
        """The key is the object's only one (or stands with ``beside``): further fields must not be lost."""
        alone = F.size(names) == 1
        if beside:
            alone = alone | ((F.size(names) == 2) & F.array_contains(names, beside))
        return F.startswith(shape, F.lit(f"OBJECT<`{key}`: ")) & alone

    return (
        F.when(shape == "VOID", VOID)
        .when(shape == "STRING", TEXT)
        .when(shape == "BIGINT", _int_kind(value, "$"))
        .when(shape.rlike("^(DECIMAL|DOUBLE|FLOAT)"), DOUBLE)
        .when(shape == "BOOLEAN", BOOLEAN)
        .when(F.startswith(shape, F.lit("ARRAY")), JSON)
        .when(shape == "DATE", DATE)
        .when(F.startswith(shape, F.lit("TIMESTAMP")), DATETIME)
        .when(shape == "BINARY", BINARY)
        .when(wrapper("$oid"), OID)
        .when(wrapper("$date"), DATETIME)
        .when(wrapper("$numberDecimal"), DECIMAL)
        .when(wrapper("$numberInt"), INT)
        .when(wrapper("$numberLong"), _int_kind(value, "$['$numberLong']"))
        .when(wrapper("$numberDouble"), DOUBLE)
        .when(wrapper("$binary", "$type"), BINARY)
        .when(wrapper("$regularExpression"), TEXT)
        .when(F.startswith(shape, F.lit("OBJECT")), JSON)
        .otherwise(TEXT)
    )


def kind_rank(kind: Column) -> Column:
    literal = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])
    return F.element_at(literal, kind)


def kind_mask(kind: Column, shape: Column) -> Column:
    """One bit per kind, plus the WRAPPED bit for numbers that came in a wrapper."""
    wrapped_number = shape.rlike(r"^OBJECT<`\$number(Int|Long|Double)`")
    bit = F.call_function("shiftleft", F.lit(1), kind)
    return bit.bitwiseOR(F.when(wrapped_number, 1 << WRAPPED).otherwise(0))


def target_type(rank: Column, profile: str) -> Column:
    literal = F.create_map(*[F.lit(x) for pair in TARGET_TYPES[profile].items() for x in pair])
    return F.element_at(literal, rank)


def _both_quotes(step: str) -> bool:
    return "'" in step and '"' in step


def variant_path(steps: list[str]) -> str:
    """Path that takes every step literally, dots and ``$`` included."""
    quoted = []
    for step in steps:
        if _both_quotes(step):
            raise ValueError(f"a path can't hold a field name with both quote characters, see descend: {step!r}")
        quoted.append(f'["{step}"]' if "'" in step else f"['{step}']")
    return "$" + "".join(quoted)


def descend(doc: Column, steps: list[str]) -> tuple[Column, str]:
    """A document and the path in it that lead to ``steps``; names that no path can hold are looked up as map keys."""
    last = max((i for i, step in enumerate(steps) if _both_quotes(step)), default=-1)
    if last < 0:
        return doc, variant_path(steps)
    above, path = descend(doc, steps[:last])
    return F.try_element_at(F.try_variant_get(above, path, "map<string,variant>"), F.lit(steps[last])), variant_path(steps[last + 1:])


def value_at(doc: Column, steps: list[str], kind: str) -> Column:
    """The value at ``steps`` as a type, NULL when it is missing or does not fit."""
    return F.try_variant_get(*descend(doc, steps), kind)


def read_value(doc: Column, steps: list[str], rank: int, kinds: int, profile: str) -> Column:
    """The value at ``steps`` as the Spark type of ``rank``; NULL when a step is missing or does not fit.

    ``kinds`` says which kinds the field holds, so only the wrappers that occur are looked for.
    """
    doc, path = descend(doc, steps)
    has = lambda *ks: any(kinds & (1 << k) for k in ks)
    get = lambda suffix, t: F.try_variant_get(doc, path + suffix, t)
    numbers = ["['$numberInt']", "['$numberLong']", "['$numberDouble']"] if has(WRAPPED) else []

    def first(options: list[Column]) -> Column:
        return options[0] if len(options) == 1 else F.coalesce(*options)

    if rank in (RANK[INT], RANK[BIGINT], RANK[DOUBLE], RANK[DECIMAL]):
        stored = STORED_TYPES[rank]
        options = [get("", stored)] + [get(n, stored) for n in numbers]
        if has(DECIMAL):
            options.append(get("['$numberDecimal']", stored))
        return first(options)
    if rank == RANK[BOOLEAN]:
        value = get("", "boolean")
        return value.cast("int") if profile == "mysql" else value
    if rank == RANK[DATETIME] or (rank == RANK[DATE] and has(DATETIME)):
        # A text with a colon is no number, and a cast that fails costs more than all the rest.
        number = F.when(~F.contains(get("['$date']", "string"), F.lit(":")), get("['$date']", "bigint"))
        return first([
            F.timestamp_millis(number),
            F.timestamp_millis(get("['$date']['$numberLong']", "bigint")),
            get("['$date']", "timestamp"),
            # A number would be read as seconds since 1970.
            F.when(F.schema_of_variant(get("", "variant")).rlike("^(TIMESTAMP|DATE)"), get("", "timestamp")),
        ])
    if rank == RANK[DATE]:
        return get("", "date")
    if rank == RANK[JSON]:
        return F.to_json(get("", "variant"))
    if rank == RANK[BINARY]:
        return F.unbase64(first([
            get("['$binary']['base64']", "string"), get("['$binary']", "string"),
        ]))
    # Object ids and text: scalars as text, wrappers as their payload.
    payloads = [get(n, "string") for n in numbers]
    payloads += [get(f"['{key}']", "string") for kind, key in (
        (OID, "$oid"), (DECIMAL, "$numberDecimal"), (DATETIME, "$date")) if has(kind)]
    if has(JSON) and payloads:  # an object with a wrapper's key among others is no wrapper
        alone = F.size(F.map_keys(get("", "map<string,variant>"))) == 1
        payloads = [F.when(alone, p) for p in payloads]
    plain = get("", "string")
    if profile == "mysql" and has(BOOLEAN):
        plain = F.when(
            F.schema_of_variant(get("", "variant")) == "BOOLEAN",
            get("", "boolean").cast("int").cast("string"),
        ).otherwise(plain)
    return first(payloads + [plain])


def is_missing(doc: Column, steps: list[str]) -> Column:
    """True where the document has no such field; an explicit null is present."""
    return value_at(doc, steps, "variant").isNull()
