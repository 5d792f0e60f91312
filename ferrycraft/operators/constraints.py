"""Keys, references and checks as audits: each returns the violations, none changes data.

Key checks combine counts on the map side before the shuffle, so a hot key costs one row per task.
Reference checks reduce the child to its distinct keys first for the same reason.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType
from pyspark.sql.utils import AnalysisException, ParseException

from .conform import one_pass
from .tried import tried_clause

# Fixed value: index prefix length on text columns.
TEXT_PREFIX = 191
#: Tasks that the rows of one key are dealt to when references are repaired.
SALTS = 8


def check_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``column_name, nulls`` for every column, in one pass."""
    return one_pass(df, [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"))
        for c in columns
    ], "column_name string, nulls bigint")


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def check_key(df: DataFrame, keys: Sequence[str], nulls: str = "reject", prefix: int | None = None,
              digest: bool = False) -> DataFrame:
    """Violating keys with their row count ``n`` and ``problem`` (``duplicate`` or ``null``).

    ``nulls``: ``reject`` for a primary key; ``distinct`` where nulls never collide; ``equal`` where one
    null is allowed. ``prefix`` compares the first characters of text keys. ``digest`` replaces text keys
    by their SHA-256, so long texts are not shuffled.
    """
    types, named = dict(df.dtypes), [F.col(f"`{c}`") for c in keys]

    def key(c: str) -> Column:
        value = F.col(f"`{c}`")
        if types[c] == "string":
            value = F.left(value, F.lit(prefix)) if prefix else value
            value = F.sha2(value, 256) if digest else value
        return value.alias(c)

    rows = df.select(*[key(c) for c in keys])
    has_null = _any_null(keys)
    if nulls == "distinct":
        rows = rows.where(~has_null)
    counts = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("n"))
    if nulls == "reject":
        counts = counts.where((F.col("n") > 1) | has_null)
        problem = F.when(has_null, "null").otherwise("duplicate")
    else:
        counts, problem = counts.where(F.col("n") > 1), F.lit("duplicate")
    return counts.withColumn("problem", problem)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    bad = check_key(df, keys, nulls="distinct").select(*[F.col(f"`{k}`") for k in keys])
    return df.join(bad, list(keys), "left_semi")


def check_foreign_key(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                      parent_columns: Sequence[str] | None = None) -> DataFrame:
    """Child keys without a parent, with their row count ``n``; a key with any null part is not checked."""
    parent_columns = list(parent_columns or columns)
    keys = _key_counts(child, {c: c for c in columns}, "n")
    parents = _key_counts(parent, dict(zip(columns, parent_columns, strict=True)), "__parents")
    return unmatched(keys, parents, columns, "__parents")


def _key_counts(df: DataFrame, columns: Mapping[str, str], alias: str) -> DataFrame:
    """Rows per complete key; ``columns`` maps output names to the frame's columns."""
    keys = df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])
    return keys.where(~_any_null(list(columns))).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias(alias))


def unmatched(keys: DataFrame, parents: DataFrame, columns: Iterable[str], marker: str) -> DataFrame:
    """Rows of an already grouped ``keys`` without a row in the equally grouped ``parents``.

    An outer join with a marker, because the optimizer moves an anti join below the grouping, where it would
    meet every row of a hot key. The join reuses both groupings' partitioning.
    """
    marked = keys.join(parents, list(columns), "left")
    return marked.where(F.col(marker).isNull()).select(*[F.col(f"`{c}`") for c in keys.columns])


def orphan_rows(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                parent_columns: Sequence[str] | None = None) -> DataFrame:
    """The child rows without a parent. The many-row side is on the left, where AQE can split a hot key."""
    parent_columns = list(parent_columns or columns)
    parents = parent.select(*[F.col(f"`{p}`").alias(c) for p, c in zip(parent_columns, columns, strict=True)])
    return child.where(~_any_null(columns)).join(parents, list(columns), "left_anti")


def resolve_orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, how: str,
                    parent_columns: Sequence[str] | None = None,
                    reassign_to: Mapping[str, object] | None = None, salts: int = SALTS) -> DataFrame:
    """``delete`` and ``reassign`` return the repaired child; ``placeholder`` the parent with missing keys added.

    A key with a NULL part refers to nothing and stays as it is.
    """
    parent_columns = list(parent_columns or columns)
    if how == "placeholder":
        missing = check_foreign_key(child, columns, parent, parent_columns).select(
            *[F.col(f"`{c}`").alias(p) for c, p in zip(columns, parent_columns, strict=True)])
        return parent.unionByName(missing, allowMissingColumns=True)
    marked = _marked(child, columns, parent, parent_columns, salts)
    orphan = ~_any_null(columns) & F.col("__parent").isNull()
    own = [F.col(f"`{c}`") for c in child.columns]
    if how == "delete":
        return marked.where(~orphan).select(*own)
    if how == "reassign":
        if not reassign_to:
            raise ValueError("reassign needs the replacement key")
        return marked.select(*[
            F.when(orphan, F.lit(reassign_to[c])).otherwise(value).alias(c) if c in reassign_to else value
            for c, value in zip(child.columns, own)])
    raise ValueError(f"unknown resolution {how!r}")


def _marked(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str],
            salts: int) -> DataFrame:
    """The child rows with ``__parent``, NULL where the key has no parent; the child is read once.

    Child rows are dealt by key and a hash of the whole row, and every parent key is held once for each of the salts,
    so a key with a third of the rows is that many tasks, whatever the session's settings.
    """
    hashable = [F.col(f"`{f.name}`") for f in child.schema.fields if "map" not in f.dataType.simpleString()
                and "variant" not in f.dataType.simpleString()]
    dealt = child.withColumn("__salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    keys = _key_counts(parent, {f"__k{i}": p for i, p in enumerate(parent_columns)}, "__parent").withColumn(
        "__of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = [F.col(f"`{c}`") == F.col(f"__k{i}") for i, c in enumerate(columns)]
    return dealt.join(keys, [*same, F.col("__salt") == F.col("__of")], "left")


# Functions of CHECK clauses that go by another name in Spark, with the same arguments.
_FUNCTIONS = {"isnull": "coalesce", "len": "length", "datalength": "octet_length", "charindex": "locate",
              "getdate": "current_timestamp", "sysdatetime": "current_timestamp", "newid": "uuid"}
_CLAUSE_TOKEN = re.compile(r"N?'(?:[^']|'')*'|\[[^\]]+\]|\w+|\s+|.", re.S)


def _like_pattern(literal: str) -> str:
    """A LIKE literal with character classes, as the literal of a regular expression."""
    parts = re.findall(r"\[\^?[^\]]+\]|.", literal[literal.index("'") + 1:-1].replace("''", "'"), re.S)
    text = "".join({"%": ".*", "_": "."}.get(p, p if len(p) > 1 else re.escape(p)) for p in parts)
    return "r'(?s)^" + text.replace("'", "\\x27") + "$'"


def spark_clause(clause: str) -> str:
    """CHECK text as a Spark expression: bracketed identifiers, renamed functions, character classes of LIKE.

    String literals are left as they are, but for the pattern of such a LIKE.
    """
    tokens, out = _CLAUSE_TOKEN.findall(clause.strip()), []
    for i, token in enumerate(tokens):
        following = next((t for t in tokens[i + 1:] if not t.isspace()), "")
        if token[0] == "[" and len(token) > 1:
            before = next((t.lower() for t in reversed(out) if not t.isspace()), "")
            token = token[1:-1] if before == "as" else f"`{token[1:-1]}`"  # a bracketed type of a cast is no column
        elif following == "(" and token.lower() in _FUNCTIONS:
            token = _FUNCTIONS[token.lower()]
        elif token.lower() == "like" and "[" in following and following.endswith("'"):
            token = "RLIKE"
        elif token.endswith("'") and len(token) > 1:
            before = next((t for t in reversed(out) if not t.isspace()), "")
            token = _like_pattern(token) if before == "RLIKE" else token.removeprefix("N")
        out.append(token)
    return "".join(out)


def unresolved(df: DataFrame, clause: str) -> str | None:
    """Why the clause is no condition over the frame's columns, or None when it is one."""
    try:
        kind = df.select(F.expr(spark_clause(clause)).alias("c")).schema["c"].dataType
    except (AnalysisException, ParseException) as e:
        return str(e)
    return None if isinstance(kind, BooleanType) else f"the clause is a {kind.simpleString()}, not a condition"


def check_expression(df: DataFrame, clause: str) -> DataFrame:
    """Rows that break the clause; as in SQL, an unknown result passes, and so does a row that can't be evaluated."""
    return df.where(~F.expr(tried_clause(spark_clause(clause))[0]))


def unevaluated_rows(df: DataFrame, clause: str) -> DataFrame:
    """Rows for which the clause would raise an error: a failed cast, a division by zero, an element beyond the end."""
    return df.where(F.expr(tried_clause(spark_clause(clause))[1]))


def in_domain(value: Column, kind: DataType, allowed: Iterable) -> Column:
    """Whether a value is one of ``allowed``; those that are no value of the column's type are equal to none."""
    same = [F.coalesce(value == F.lit(a).try_cast(kind), F.lit(False)) for a in allowed if a is not None]
    return reduce(lambda a, b: a | b, same, F.lit(False))


def check_domain(df: DataFrame, column: str, allowed: Iterable | DataFrame) -> DataFrame:
    """Values outside the domain and their row counts. A large domain is given as a one-column DataFrame."""
    values = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias("n"))
    if isinstance(allowed, DataFrame):
        return unmatched(values, _key_counts(allowed, {column: allowed.columns[0]}, "__known"), [column], "__known")
    return values.where(~in_domain(F.col(f"`{column}`"), df.schema[column].dataType, allowed))


def apply_delete(child: DataFrame, columns: Sequence[str], deleted: DataFrame, action: str,
                 parent_columns: Sequence[str] | None = None,
                 default: Mapping[str, object] | None = None) -> DataFrame:
    """Effect of deleting parent keys. RESTRICT and NO ACTION return the blocked keys, the others the child."""
    parent_columns = list(parent_columns or columns)
    gone = deleted.select(
        *[F.col(f"`{p}`").alias(c) for p, c in zip(parent_columns, columns, strict=True)]).distinct()
    action = action.upper().replace("_", " ")
    if action == "CASCADE":
        return child.join(gone, list(columns), "left_anti")
    if action in ("RESTRICT", "NO ACTION"):
        named = [F.col(f"`{c}`") for c in columns]
        used = child.select(*named).groupBy(*named).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
        return gone.join(used, list(columns), "left_semi")
    if action in ("SET NULL", "SET DEFAULT"):
        fill = default if action == "SET DEFAULT" else {}
        marked = child.join(gone.withColumn("__gone", F.lit(True)), list(columns), "left")
        return marked.select(*[
            (F.when(F.col("__gone"), F.lit(fill.get(c))).otherwise(F.col(f"`{c}`")) if c in columns
             else F.col(f"`{c}`")).alias(c)
            for c in child.columns
        ])
    raise ValueError(f"unknown action {action!r}")


@dataclass(frozen=True)
class Constraint:
    """One constraint of ``table``. ``kind``: NOT NULL, PRIMARY KEY, UNIQUE, FOREIGN KEY, CHECK or DOMAIN."""

    name: str
    kind: str
    table: str
    columns: tuple[str, ...] = ()
    clause: str = ""
    allowed: tuple = ()
    ref_table: str = ""
    ref_columns: tuple[str, ...] = ()
    nulls: str = "distinct"
    prefix: int | None = None


def audit_constraints(tables: Mapping[str, DataFrame], constraints: Iterable[Constraint]) -> DataFrame:
    """``constraint_name, kind, table_name, violations, unevaluated, status, reason`` per constraint.

    ``violations`` counts rows (for keys: rows beyond those allowed). All row-level constraints of a table
    share one scan; keys and references add one combined aggregate each. A reference to a parent key that
    is not unique is INVALID_PARENT. A constraint that can't be resolved against the tables (a clause with a function
    that Spark lacks, a missing column or table, a column of no comparable type) is SKIPPED with the reason, and the
    others are audited. ``unevaluated`` counts rows that a CHECK raises an error for; they break nothing.
    """
    given, constraints, skipped = list(constraints), [], []
    for c in given:
        reason = _unresolved(tables, c)
        if reason is None:
            constraints.append(c)
        else:
            skipped.append((c.name, c.kind, c.table, None, None, "SKIPPED", reason))
    schema = ("constraint_name string, kind string, table_name string, violations bigint, unevaluated bigint, "
              "status string, reason string")
    result = lambda c, violations, unevaluated=F.lit(0): F.struct(
        F.lit(c.name).alias("constraint_name"), F.lit(c.kind).alias("kind"), F.lit(c.table).alias("table_name"),
        violations.cast("bigint").alias("violations"), unevaluated.cast("bigint").alias("unevaluated"),
        F.lit(False).alias("bad_parent"))
    parts = []
    by_table: dict[str, list[Column]] = {}
    for c in constraints:
        failed = F.lit(False)
        if c.kind == "NOT NULL":
            broken = _any_null(c.columns)
        elif c.kind == "CHECK":
            text, failing = tried_clause(spark_clause(c.clause))
            broken, failed = ~F.expr(text), F.expr(failing)
        elif c.kind == "DOMAIN":
            value = F.col(f"`{c.columns[0]}`")
            broken = value.isNotNull() & ~in_domain(value, tables[c.table].schema[c.columns[0]].dataType, c.allowed)
        else:
            continue
        by_table.setdefault(c.table, []).append(result(
            c, F.count_if(F.coalesce(broken, F.lit(False))), F.count_if(F.coalesce(failed, F.lit(False)))))
    parts += [tables[t].agg(F.array(*structs).alias("m")).select(F.inline("m")) for t, structs in by_table.items()]
    for c in constraints:
        if c.kind in ("PRIMARY KEY", "UNIQUE"):
            primary = c.kind == "PRIMARY KEY"
            bad = check_key(tables[c.table], c.columns, "reject" if primary else c.nulls, c.prefix)
            extra = F.when(F.col("problem") == "null", F.col("n")).otherwise(F.col("n") - 1)
            parts.append(bad.agg(result(c, F.coalesce(F.sum(extra), F.lit(0))).alias("r")).select("r.*"))
        elif c.kind == "FOREIGN KEY":
            refs = c.ref_columns or c.columns
            keys = _key_counts(tables[c.table], {k: k for k in c.columns}, "n")
            # Both uses of the grouped parent share one shuffle.
            parents = _key_counts(tables[c.ref_table], dict(zip(c.columns, refs, strict=True)), "__parents")
            bad = unmatched(keys, parents, c.columns, "__parents")
            doubled = parents.where(F.col("__parents") > 1)
            zero = F.lit(0).cast("bigint")
            both = bad.select(F.col("n").alias("orphans"), zero.alias("doubled")).unionByName(
                doubled.select(zero.alias("orphans"), F.lit(1).cast("bigint").alias("doubled")))
            parts.append(both.agg(
                result(c, F.coalesce(F.sum("orphans"), F.lit(0))).alias("r"),
                (F.coalesce(F.sum("doubled"), F.lit(0)) > 0).alias("bad_parent"),
            ).select(F.col("r").dropFields("bad_parent").alias("r"), "bad_parent").select("r.*", "bad_parent"))
    if not parts:
        return SparkSession.active().createDataFrame(skipped, schema)
    merged = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("bad_parent"), "INVALID_PARENT").when(F.col("violations") > 0, "VIOLATED").otherwise("VALID"))
    report = merged.withColumn("status", status).drop("bad_parent").withColumn("reason", F.lit(None).cast("string"))
    return report.unionByName(report.sparkSession.createDataFrame(skipped, schema)) if skipped else report


def _unresolved(tables: Mapping[str, DataFrame], c: Constraint) -> str | None:
    """Why a constraint can't be audited: what it names is missing, or its parts can't be put together."""
    if c.kind not in ("NOT NULL", "PRIMARY KEY", "UNIQUE", "FOREIGN KEY", "CHECK", "DOMAIN"):
        return f"unknown kind {c.kind}"
    if c.kind != "CHECK" and not c.columns:
        return "no columns named"
    refs = (c.ref_columns or c.columns) if c.kind == "FOREIGN KEY" else ()
    for name, columns in ((c.table, c.columns), *([(c.ref_table, refs)] if c.kind == "FOREIGN KEY" else [])):
        if name not in tables:
            return f"no table {name}"
        missing = [k for k in columns if k not in tables[name].columns]
        if missing:
            return f"no column {', '.join(missing)} in {name}"
    if c.kind == "CHECK":
        return unresolved(tables[c.table], c.clause) or unresolved(tables[c.table], tried_clause(spark_clause(c.clause))[1])
    if c.kind == "FOREIGN KEY" and len(refs) != len(c.columns):
        return f"{len(c.columns)} columns refer to {len(refs)}"
    # what is left, a key of a type that can't be grouped or compared, shows when the plan is made
    df = tables[c.table]
    try:
        if c.kind == "DOMAIN":
            df.select(in_domain(F.col(f"`{c.columns[0]}`"), df.schema[c.columns[0]].dataType, c.allowed)).schema
        elif c.kind in ("PRIMARY KEY", "UNIQUE"):
            check_key(df, c.columns, c.nulls, c.prefix).schema
        elif c.kind == "FOREIGN KEY":
            check_foreign_key(df, c.columns, tables[c.ref_table], refs).schema
    except Exception as e:  # noqa: BLE001  any reason is the answer
        return str(e).splitlines()[0]
    return None


def constraint_tally(report: DataFrame) -> DataFrame:
    """Constraints that can be added and those to skip, per kind."""
    return report.groupBy("kind").agg(
        F.count_if(F.col("status") == "VALID").alias("added"),
        F.count_if(F.col("status") != "VALID").alias("skipped"))
