"""Relational source types: target type names, the Spark types we store, and DEFAULT expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Target type of each source type, per target profile. Types whose target depends on
# length or precision are completed in map_type().
PG_TYPES = {
    "tinyint": "smallint", "smallint": "smallint", "int": "integer", "integer": "integer",
    "bigint": "bigint", "bit": "boolean", "money": "numeric(19,4)", "smallmoney": "numeric(10,4)",
    "float": "double precision", "real": "real", "date": "date", "time": "time",
    "datetime": "timestamp", "datetime2": "timestamptz", "smalldatetime": "timestamp",
    "datetimeoffset": "timestamptz", "text": "text", "ntext": "text", "image": "bytea",
    "binary": "bytea", "varbinary": "bytea", "uniqueidentifier": "uuid", "xml": "text",
    "geography": "text", "geometry": "text", "hierarchyid": "text", "sql_variant": "text",
    "rowversion": "bytea", "timestamp": "bytea",
}
MYSQL_TYPES = {
    "tinyint": "TINYINT UNSIGNED", "smallint": "SMALLINT", "int": "INT", "integer": "INT",
    "bigint": "BIGINT", "bit": "TINYINT(1)", "money": "DECIMAL(19,4)", "smallmoney": "DECIMAL(10,4)",
    "float": "DOUBLE", "real": "FLOAT", "date": "DATE", "time": "TIME", "datetime": "DATETIME",
    "datetime2": "DATETIME(6)", "smalldatetime": "DATETIME", "datetimeoffset": "DATETIME(6)",
    "text": "LONGTEXT", "ntext": "LONGTEXT", "image": "LONGBLOB", "binary": "BLOB",
    "varbinary": "LONGBLOB", "uniqueidentifier": "CHAR(36)", "xml": "LONGTEXT",
    "geography": "LONGTEXT", "geometry": "LONGTEXT", "hierarchyid": "VARCHAR(256)",
    "sql_variant": "LONGTEXT", "rowversion": "BIGINT UNSIGNED", "timestamp": "BIGINT UNSIGNED",
}
BSON_TYPES = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "long",
    "bit": "bool", "money": "decimal128", "smallmoney": "decimal128", "float": "double",
    "real": "double", "decimal": "decimal128", "numeric": "decimal128", "date": "date",
    "time": "string", "datetime": "date", "datetime2": "date", "smalldatetime": "date",
    "datetimeoffset": "date", "char": "string", "nchar": "string", "varchar": "string",
    "nvarchar": "string", "text": "string", "ntext": "string", "binary": "binData",
    "varbinary": "binData", "image": "binData", "uniqueidentifier": "string", "xml": "string",
    "geography": "string", "geometry": "string", "hierarchyid": "string", "sql_variant": "string",
    "rowversion": "long", "timestamp": "long",
}
# Types a client driver cannot fetch natively; they are cast to text in the source query.
TEXT_CAST_TYPES = ("geography", "geometry", "hierarchyid", "xml", "sql_variant")
# DEFAULT spellings and their target expression.
PG_NOW = {
    "CURRENT_TIMESTAMP": ("getdate()", "getdate", "sysdatetime()", "sysdatetime", "sysdatetimeoffset()"),
    "NOW()": ("getutcdate()", "getutcdate", "sysutcdatetime()", "sysutcdatetime"),
}
MYSQL_NOW = {
    "CURRENT_TIMESTAMP": ("getdate()", "getdate", "getutcdate()", "getutcdate",
                          "sysutcdatetime()", "sysutcdatetime"),
    "CURRENT_TIMESTAMP(6)": ("sysdatetime()", "sysdatetime", "sysdatetimeoffset()"),
}
NEW_UUID = ("newid()", "newid", "newsequentialid()", "newsequentialid")
PG_UUID, MYSQL_UUID = "gen_random_uuid()", "(UUID())"

_UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
# What Python's float() accepts after trimming.
_NUMBER = (
    r"(?i)^[+-]?(inf(inity)?|nan|"
    r"(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?)$"
)


def base_type(data_type: Column) -> Column:
    return F.lower(F.trim(data_type))


def needs_text_cast(data_type: Column) -> Column:
    return base_type(data_type).isin(*TEXT_CAST_TYPES)


def _lookup(table: dict[str, str], base: Column, fallback: str) -> Column:
    """Constant map lookup: no join, folded into the projection."""
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, base), F.lit(fallback))


def map_type(profile: str, data_type: Column, max_length: Column, precision: Column, scale: Column) -> Column:
    """Target type name of a source column; lengths are integers, NULL where the source has none."""
    base = base_type(data_type)
    sized = lambda name, *args: F.format_string(f"{name}({','.join(['%d'] * len(args))})", *args)
    if profile == "bson":
        return _lookup(BSON_TYPES, base, "string")
    if profile == "pg":
        varying = (
            F.when(max_length.isNull() | (max_length == -1), "text").otherwise(sized("varchar", max_length))
        )
        exact = (
            F.when(precision.isNull(), "numeric")
            .when(scale.isNull(), sized("numeric", precision))
            .otherwise(sized("numeric", precision, scale))
        )
        return (
            F.when(base.isin("varchar", "nvarchar", "char", "nchar"), varying)
            .when(base.isin("decimal", "numeric"), exact)
            .when((base == "float") & (precision <= 24), "real")
            .otherwise(_lookup(PG_TYPES, base, "text"))
        )
    if profile == "mysql":
        varying = (
            F.when(max_length.isNull() | (max_length == -1), "LONGTEXT")
            .when(max_length > 16383, "MEDIUMTEXT")
            .otherwise(sized("VARCHAR", max_length))
        )
        fixed = F.when(max_length <= 255, sized("CHAR", max_length)).otherwise("VARCHAR(255)")
        exact = (
            F.when(precision.isNull(), "DECIMAL(18,4)")
            .otherwise(sized("DECIMAL", precision, F.coalesce(scale, F.lit(0))))
        )
        return (
            F.when(base.isin("varchar", "nvarchar"), varying)
            .when(base.isin("char", "nchar"), fixed)
            .when(base.isin("decimal", "numeric"), exact)
            .when((base == "float") & (precision <= 24), "FLOAT")
            .otherwise(_lookup(MYSQL_TYPES, base, "LONGTEXT"))
        )
    raise ValueError(f"unknown profile {profile!r}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_outer_parens(expression: Column) -> Column:
    """Drop the parentheses that wrap the whole expression, however many layers.

    A layer is removable only if the nesting depth between the leading and the trailing run of
    parentheses never falls below it, so ``(a)+(b)`` keeps both pairs.
    """
    part = lambda text, group: F.regexp_extract(text, r"(?s)^([\s(]*)(.*?)([\s)]*)$", group)
    parens = lambda run: F.length(F.regexp_replace(run, r"\s", ""))

    def step(acc: Column, ch: Column) -> Column:
        depth = acc["depth"] + F.when(ch == "(", 1).when(ch == ")", -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.least(acc["low"], depth).alias("low"))

    def unwrap(p: Column) -> Column:
        low = F.aggregate(F.split(p["inner"], ""), F.struct(
            p["opened"].alias("depth"), p["opened"].alias("low")), step)["low"]
        layers = F.greatest(F.least(p["opened"], p["closed"], low), F.lit(0))
        return let(layers, lambda n: F.trim(F.concat(
            F.repeat(F.lit("("), p["opened"] - n), p["inner"], F.repeat(F.lit(")"), p["closed"] - n))))

    def wrapped(text: Column) -> Column:
        return let(F.struct(
            parens(part(text, 1)).alias("opened"), part(text, 2).alias("inner"),
            parens(part(text, 3)).alias("closed")), unwrap)

    return let(F.trim(expression), lambda text: F.when(
        F.startswith(text, F.lit("(")) & F.endswith(text, F.lit(")")), wrapped(text)).otherwise(text))


def translate_default(default: Column, target_type: Column, profile: str) -> Column:
    """DEFAULT expression in the target's spelling; NULL means leave the default out."""
    now, new_uuid = (PG_NOW, PG_UUID) if profile == "pg" else (MYSQL_NOW, MYSQL_UUID)
    truth = F.lit(profile == "pg") & target_type.startswith("boolean")

    def translated(value: Column) -> Column:
        return let(F.lower(value), lambda low: by_form(value, low))

    def by_form(value: Column, low: Column) -> Column:
        out = F.when(low.isin(*NEW_UUID), new_uuid)
        for target, spellings in now.items():
            out = out.when(low.isin(*spellings), target)
        return (
            out.when(low == "null", "NULL")
            .when(low.isin("''", "n''"), "''")
            .when(low == "1", F.when(truth, "true").otherwise("1"))
            .when(low == "0", F.when(truth, "false").otherwise("0"))
            .when(value.rlike(_NUMBER), value)
            .when(low.rlike(r"(?s)^n'.*'$"), F.substring(value, 2, 2147483647))
            .when(value.rlike(r"(?s)^'.*'$"), value)
        )

    return F.when(default != "", let(strip_outer_parens(default), translated))


@dataclass(frozen=True)
class ColumnSpec:
    """One source column as the catalogue describes it."""

    name: str
    data_type: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    default: str | None = None

    @property
    def base(self) -> str:
        return self.data_type.strip().lower()

    def text_limit(self, profile: str) -> int | None:
        """Longest text the target column holds."""
        if profile == "bson":
            return None
        n = None if self.max_length in (None, -1) else self.max_length
        if self.base in ("varchar", "nvarchar"):
            return None if profile == "mysql" and n and n > 16383 else n
        if self.base in ("char", "nchar"):
            return n if profile == "pg" or (n and n <= 255) else 255
        if profile == "mysql":
            return {"uniqueidentifier": 36, "hierarchyid": 256}.get(self.base)
        return None

    def bounds(self, profile: str) -> tuple[int, int] | None:
        """Value range where the stored Spark type is wider than the target type."""
        return (0, 255) if self.base == "tinyint" and profile == "mysql" else None

    def pattern(self, profile: str) -> str | None:
        return _UUID if self.base == "uniqueidentifier" and profile == "pg" else None

    def spark_type(self, profile: str) -> str:
        if self.base in ("decimal", "numeric"):
            if self.precision is None:
                return "decimal(18,4)" if profile == "mysql" else "decimal(38,18)"
            return f"decimal({self.precision},{self.scale or 0})"
        if self.base == "float":
            small = profile != "bson" and self.precision is not None and self.precision <= 24
            return "float" if small else "double"
        if self.base == "real":
            return "double" if profile == "bson" else "float"
        if self.base == "date":
            return "timestamp" if profile == "bson" else "date"
        if self.base in ("datetime2", "datetimeoffset"):
            return "timestamp" if profile == "pg" else "timestamp_ntz"
        if self.base in ("rowversion", "timestamp"):
            return "decimal(20,0)" if profile == "mysql" else "binary"
        return SPARK_TYPES.get(self.base, "string")


SPARK_TYPES = {
    "tinyint": "smallint", "smallint": "smallint", "int": "int", "integer": "int", "bigint": "bigint",
    "bit": "boolean", "money": "decimal(19,4)", "smallmoney": "decimal(10,4)",
    "datetime": "timestamp_ntz", "smalldatetime": "timestamp_ntz",
    "image": "binary", "binary": "binary", "varbinary": "binary",
}
