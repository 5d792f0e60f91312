"""Text clean-up, literals and target names."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


# All suspects lie above; a class of one range spares most texts the class of hundreds.
_BEYOND_LATIN, _LATIN = r"[^\x{0000}-\x{02FF}]", r"[\x{0000}-\x{02FF}]+"


_GAP = 16


def nfc_suspects() -> list[int]:
    """Code points that text in NFC may lack or hold only in some places (quick check "no" or "maybe").

    Those that NFC changes, combining marks, and the second halves of compositions, the vowels and final
    consonants of Hangul among them. Text without any of them is in NFC.
    """
    second = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    out = set()
    for point in range(0x110000):
        char = chr(point)
        parts = unicodedata.decomposition(char)
        if parts and parts[0] != "<" and " " in parts:
            second.add(int(parts.split()[1], 16))
        if unicodedata.combining(char) or (parts and not unicodedata.is_normalized("NFC", char)):
            out.add(point)
    return sorted(out | second)


@functools.cache
def _may_change_under_nfc() -> str:
    """The suspects, and what lies in narrow gaps between them, as a character class of few ranges."""
    ranges: list[list[int]] = []
    for point in nfc_suspects():
        if ranges and point - ranges[-1][1] <= _GAP:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(rf"\x{{{a:04X}}}-\x{{{b:04X}}}" for a, b in ranges) + "]"


@F.pandas_udf(StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def normalize_text(text: Column) -> Column:
    """NUL characters removed, then Unicode NFC.

    Spark has no built-in normaliser. The Python function is fed NULL for every row that passes the quick check,
    whatever its script, so only the few strings that may change cross to Python, in one scan.
    """
    clean = strip_nul(text)
    return F.coalesce(_nfc(F.when(clean.rlike(_BEYOND_LATIN) & F.regexp_replace(clean, _LATIN, "").rlike(_may_change_under_nfc()), clean)), clean)


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def binary_literal(data: Column) -> Column:
    """Bytes as a ``\\x…`` hex literal."""
    return F.concat(F.lit("\\x"), F.lower(F.hex(data)))


def parse_binary_literal(text: Column) -> Column:
    return F.unhex(F.substring(text, 3, 2147483647))


def target_column(field: Column) -> Column:
    """Dotted field path to a column name."""
    return F.lower(F.replace(F.replace(field, F.lit("."), F.lit("_")), F.lit("$"), F.lit("")))


def target_table(schema: Column, table: Column, profile: str = "pg") -> Column:
    """``schema.table`` for PostgreSQL; ``schema_table`` elsewhere, so same-named tables of two schemas stay apart."""
    return F.lower(F.concat_ws("." if profile == "pg" else "_", schema, table))


def identifier(name: Column, profile: str = "pg") -> Column:
    """Object name cut to the target's limit."""
    return F.left(name, F.lit(IDENTIFIER_LIMIT[profile]))


def index_identifier(table: Column, index: Column, profile: str = "pg") -> Column:
    """PostgreSQL index names are unique per schema, so the table name goes in front."""
    full = F.concat_ws("_", F.lit("idx"), table, index) if profile == "pg" else index
    return identifier(full, profile)


# The longest object name each target accepts.
IDENTIFIER_LIMIT = {"pg": 63, "mysql": 64}
