"""The graph of references: what a delete reaches over all tables, and the order in which tables can be loaded.

All steps are joins and groupings over frontiers, so a round costs what it newly reaches; each round is a table in the
shared folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage


@dataclass(frozen=True)
class Reference:
    """``table(columns)`` refers to ``parent(parent_columns)``; ``action`` is what a delete of the parent does."""

    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    action: str = "NO ACTION"


@dataclass(frozen=True)
class CascadeResult:
    """``deleted``: table_name, key. ``changed``: table_name, key, reference, action (rows that stay and lose their
    parent). ``blocked``: key of a root that stays, with the reference and the row that hold it. Keys are JSON texts.
    ``rounds`` is how deep the cascade went."""

    deleted: DataFrame
    changed: DataFrame
    blocked: DataFrame
    rounds: int


def row_key(columns: Iterable[str]) -> Column:
    """A row's key as JSON, the same for all tables whatever the columns' types."""
    return _json(F.struct(*_quoted(columns)))


def _json(row: Column | str) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def _quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


class _Cascade:
    def __init__(self, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], references: Iterable[Reference]):
        self.tables, self.keys, self.references = tables, keys, list(references)
        for r in self.references:
            if len(r.columns) != len(r.parent_columns):
                raise ValueError(f"{r.name}: {len(r.columns)} columns refer to {len(r.parent_columns)}")
        self.actions = {r.name: r.action.upper().replace("_", " ") for r in self.references}
        # a table's rows by the columns that refer or are referred to, with the key that names them
        used: dict[str, set[str]] = {}
        for r in self.references:
            used.setdefault(r.table, set()).update(r.columns)
            used.setdefault(r.parent, set()).update(r.parent_columns)
        self.columns = {t: sorted(c) for t, c in used.items()}

    def used(self, table: str) -> Column:
        return F.struct(*_quoted(self.columns.get(table, [])) or [F.lit(1).alias("none")])

    def slim(self, table: str) -> DataFrame:
        return self.tables[table].select(row_key(self.keys[table]).alias("node"), self.used(table).alias("row"))

    def children(self, r: Reference, parents: DataFrame) -> DataFrame:
        """``child_node, child_row, parent_node`` of the rows that refer to ``parents``; the many side is on the left.

        Keys become texts behind the join, so a round makes those of the rows that it finds.
        """
        named = [f"k{i}" for i in range(len(r.columns))]
        child = self.tables[r.table].select(
            F.struct(*_quoted(self.keys[r.table])).alias("child_key"), self.used(r.table).alias("child_row"),
            *[F.col(f"`{c}`").alias(k) for c, k in zip(r.columns, named)])
        parent = parents.select(F.col("node").alias("parent_node"),
                                *[F.col(f"row.`{c}`").alias(f"p{k}") for c, k in zip(r.parent_columns, named)])
        return child.join(parent, [F.col(k) == F.col(f"p{k}") for k in named]).select(
            _json("child_key").alias("child_node"), "child_row", "parent_node")

    def staying(self, r: Reference, reached: dict[str, DataFrame]) -> DataFrame:
        """Rows that refer to reached ones by ``r`` and aren't reached themselves."""
        found = self.children(r, reached[r.parent])
        if r.table not in reached:
            return found
        return found.join(reached[r.table].select(F.col("node").alias("child_node")), "child_node", "left_anti")

    def holders(self, reached: dict[str, DataFrame]) -> list[DataFrame]:
        """``table_name, node, by``: reached rows with a referring row that keeps them."""
        out = []
        for r in self.references:
            if self.actions[r.name] in ("RESTRICT", "NO ACTION") and r.parent in reached:
                found = (self.staying(r, reached) if self.actions[r.name] == "NO ACTION"
                         else self.children(r, reached[r.parent]))
                out.append(found.select(F.lit(r.parent).alias("table_name"), F.col("parent_node").alias("node"), F.struct(
                    F.lit(r.table).alias("table_name"), F.col("child_node").alias("key"),
                    F.lit(r.name).alias("reference")).alias("by")))
        return out

    def reach(self, table: str, roots: DataFrame) -> tuple[dict[str, DataFrame], DataFrame | None, int]:
        """Rows that cascades reach from ``roots``, each once, and the steps (parent to child) on the way."""
        start = stage(roots, "reached")
        reached, frontier, steps, rounds = {table: [start]}, {table: start}, [], 0
        while frontier:
            new: dict[str, list[DataFrame]] = {}
            for r in self.references:
                if self.actions[r.name] != "CASCADE" or r.parent not in frontier:
                    continue
                found = stage(self.children(r, frontier[r.parent]), "cascade")
                steps.append(found.select(F.lit(r.parent).alias("parent_table"), "parent_node",
                                          F.lit(r.table).alias("child_table"), "child_node"))
                new.setdefault(r.table, []).append(found.select(F.col("child_node").alias("node"),
                                                                F.col("child_row").alias("row")))
            frontier = {}
            for name, parts in new.items():
                fresh = reduce(DataFrame.union, parts).dropDuplicates(["node"])
                for known in reached.get(name, []):
                    fresh = fresh.join(known.select("node"), "node", "left_anti")
                fresh = stage(fresh, "reached")
                if not fresh.isEmpty():
                    frontier[name] = fresh
                    reached.setdefault(name, []).append(fresh)
            rounds += bool(frontier)
        whole = {name: reduce(DataFrame.union, parts) for name, parts in reached.items()}
        return whole, reduce(DataFrame.union, steps) if steps else None, rounds


def cascade_delete(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], references: Iterable[Reference],
                   root: str, deleted: DataFrame) -> CascadeResult:
    """What deleting rows of ``root`` does to all tables that refer to it, over any number of references and cycles.

    ``deleted`` holds the key columns of the rows to delete; each is a delete of its own, and those that can go do.
    CASCADE deletes the referring rows too, and so on. SET NULL and SET DEFAULT keep them and report them as changed.
    RESTRICT keeps the parent, and with it every row whose delete would reach it: a root that can't go stays
    whole, and ``blocked`` names the row that holds it (the least by table, key and reference). NO ACTION does so
    unless the referring row goes as well. A key with a NULL part refers to nothing; keys that no row has are left out.
    """
    work = _Cascade(tables, keys, references)
    asked = deleted.select(row_key(keys[root]).alias("node")).distinct()
    allowed = stage(work.slim(root).join(asked, "node", "left_semi"), "roots")
    told = []
    while True:  # a root that stays keeps rows that NO ACTION children of others may be among
        reached, steps, rounds = work.reach(root, allowed)
        held = _held(work.holders(reached), steps)
        if held is None:
            break
        own = held.where(F.col("table_name") == root).select("node", "by")
        blocked = stage(allowed.select("node").join(own, "node"), "blocked")
        if blocked.isEmpty():
            break
        told.append(blocked)
        allowed = stage(allowed.join(blocked.select("node"), "node", "left_anti"), "roots")
    gone = reduce(DataFrame.union, [rows.select(F.lit(t).alias("table_name"), F.col("node").alias("key"))
                                    for t, rows in reached.items()])
    changed = [work.staying(r, reached).select(
        F.lit(r.table).alias("table_name"), F.col("child_node").alias("key"), F.lit(r.name).alias("reference"),
        F.lit(work.actions[r.name]).alias("action")).distinct()
        for r in work.references if work.actions[r.name] in ("SET NULL", "SET DEFAULT") and r.parent in reached]
    empty = asked.sparkSession.createDataFrame
    return CascadeResult(
        gone, reduce(DataFrame.union, changed, empty([], "table_name string, key string, reference string, action string")),
        reduce(DataFrame.union, [b.select(
            F.col("node").alias("key"), F.col("by.reference").alias("reference"), F.col("by.table_name").alias("held_by_table"),
            F.col("by.key").alias("held_by_key")) for b in told],
            empty([], "key string, reference string, held_by_table string, held_by_key string")), rounds)


def _held(holders: list[DataFrame], steps: DataFrame | None) -> DataFrame | None:
    """``table_name, node, by`` of the reached rows that can't go: held themselves, or a parent of one that is."""
    if not holders:
        return None
    least = lambda rows: rows.groupBy("table_name", "node").agg(F.min("by").alias("by"))
    held = stage(least(reduce(DataFrame.union, holders)), "held")
    if held.isEmpty() or steps is None:
        return None if held.isEmpty() else held
    steps = stage(steps.distinct(), "steps")
    held = held.withColumn("new", F.lit(True))
    while True:
        at = held.where("new").select(F.col("table_name").alias("child_table"), F.col("node").alias("child_node"), "by")
        up = steps.join(at, ["child_table", "child_node"]).select(
            F.col("parent_table").alias("table_name"), F.col("parent_node").alias("node"), "by", F.lit(None).alias("was"))
        # the least holder travels, so that the answer doesn't depend on the order of rounds
        known = held.select("table_name", "node", "by", F.col("by").alias("was"))
        held = stage(known.union(up).groupBy("table_name", "node").agg(F.min("by").alias("by"), F.min("was").alias("was")).select(
            "table_name", "node", "by", (F.col("was").isNull() | (F.col("by") < F.col("was"))).alias("new")), "held")
        if held.where("new").isEmpty():
            return held.drop("new")


def _reaching(edges: DataFrame, colors: DataFrame) -> DataFrame:
    """``node, color``: the largest color that reaches each node along ``a`` to ``b``; only new colors travel on."""
    colors = colors.withColumn("new", F.lit(True))
    while True:
        carried = edges.join(colors.where("new").select(F.col("node").alias("a"), "color"), "a").select(
            F.col("b").alias("node"), "color", F.lit(None).alias("was"))
        known = colors.select("node", "color", F.col("color").alias("was"))
        colors = stage(known.union(carried).groupBy("node").agg(F.max("color").alias("color"), F.max("was").alias("was")).select(
            "node", "color", (F.col("was").isNull() | (F.col("color") > F.col("was"))).alias("new")), "colors")
        if colors.where("new").isEmpty():
            return colors.drop("new")


def _core(edges: DataFrame) -> DataFrame:
    """Edges between nodes that have edges in and out; what is peeled off lies on no cycle."""
    left = edges.count()
    while True:
        ends = edges.select(F.col("b").alias("a")).distinct(), edges.select(F.col("a").alias("b")).distinct()
        edges = stage(edges.join(ends[0], "a", "left_semi").join(ends[1], "b", "left_semi"), "core")
        before, left = left, edges.count()
        if left == before:
            return edges


def strong_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of the ``a``, ``b`` edges: the least node that it reaches and that reaches it.

    Nodes on no cycle are peeled off first. Then forward and backward steps of labels (Orzan's coloring): the largest
    name that reaches a node colors it, and the nodes of a color that reach back to that name are one component. Each
    pass settles a component at least in every part that is left. A component has one color, so edges between colors are
    cut before the next pass, and what they held between two cycles is peeled off.
    """
    edges = stage(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    nodes = stage(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct(), "nodes")
    done = nodes.limit(0).select("node", F.col("node").alias("color"))
    while not (edges := _core(edges)).isEmpty():
        left = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        colors = _reaching(edges, stage(left.withColumn("color", F.col("node")), "colors"))
        color = lambda n: colors.select(F.col("node").alias(n), F.col("color").alias(f"c{n}"))
        inside = stage(edges.join(color("a"), "a").join(color("b"), "b").where("ca = cb").select("a", "b"), "inside")
        found = stage(colors.where("node = color"), "found")
        fresh = found
        while not fresh.isEmpty():
            back = inside.join(fresh.select(F.col("node").alias("b"), "color"), "b").select(F.col("a").alias("node"), "color")
            fresh = stage(back.distinct().join(found.select("node"), "node", "left_anti"), "found")
            found = found.union(fresh)
        done = done.union(found)
        settled = lambda n: found.select(F.col("node").alias(n))
        edges = stage(inside.join(settled("a"), "a", "left_anti").join(settled("b"), "b", "left_anti"), "edges")
    least = done.groupBy("color").agg(F.min("node").alias("component"))
    homes = done.join(least, "color").select(F.col("node").alias("of"), "component")
    return nodes.join(homes, F.col("node") == F.col("of"), "left").select("node", F.coalesce("component", "node").alias("component"))


def load_order(tables: DataFrame, references: DataFrame) -> DataFrame:
    """``table_name, level, cycle, in_cycle_with``: tables of a level refer to earlier levels only, or to their own cycle.

    ``tables``: table_name. ``references``: table_name, ref_table; a reference to an unknown table is left out, a repeated
    one counts once. ``cycle`` names the cycle a table is in by its least table, NULL outside cycles; a table that refers
    to itself is a cycle of its own. Tables of a cycle share a level: their checks must be off, or deferred, while it
    is loaded, and ``in_cycle_with`` counts them.
    """
    tables = stage(tables.select("table_name").where("table_name IS NOT NULL").distinct(), "tables")
    known = references.join(tables, "table_name", "left_semi").join(
        tables.select(F.col("table_name").alias("ref_table")), "ref_table", "left_semi").select("table_name", "ref_table").distinct()
    known = stage(known, "references")
    found = strong_components(known.select(F.col("table_name").alias("a"), F.col("ref_table").alias("b")))
    home = stage(tables.join(found.withColumnRenamed("node", "table_name"), "table_name", "left").select(
        "table_name", F.coalesce("component", "table_name").alias("component")), "components")
    own = lambda n, c: home.select(F.col("table_name").alias(n), F.col("component").alias(c))
    between = stage(known.join(own("table_name", "a"), "table_name").join(own("ref_table", "b"), "ref_table").where(
        "a <> b").select("a", "b").distinct(), "between")
    # a component follows when the last one that it refers to has come: each reference is followed once
    asks = between.groupBy("a").agg(F.count(F.lit(1)).alias("asks"))
    asked = stage(between.join(asks, "a"), "between")
    ready = stage(home.select("component").distinct().join(
        asks.select(F.col("a").alias("component")), "component", "left_anti"), "levels")
    levels, waiting = ready.withColumn("level", F.lit(0)), asked.select("a", "asks", F.lit(0).cast("long").alias("come")).limit(0)
    level = 0
    while not ready.isEmpty():
        level += 1
        come = asked.join(ready.select(F.col("component").alias("b")), "b").select(
            "a", "asks", F.lit(1).cast("long").alias("come"))
        met = stage(waiting.union(come).groupBy("a", "asks").agg(F.sum("come").alias("come")), "met")
        ready = met.where("come = asks").select(F.col("a").alias("component"))
        waiting = met.where("come < asks")
        levels = levels.union(ready.withColumn("level", F.lit(level)))
    own_loop = known.where("table_name = ref_table").select("table_name", F.lit(True).alias("loop"))
    sizes = home.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    cyclic = (F.col("size") > 1) | F.coalesce("loop", F.lit(False))
    return home.join(levels, "component").join(sizes, "component").join(own_loop, "table_name", "left").select(
        "table_name", "level", F.when(cyclic, F.col("component")).alias("cycle"),
        F.when(cyclic, F.col("size")).alias("in_cycle_with"))
