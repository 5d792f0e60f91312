"""Cascades over reference graphs, strong components, load order; against plain Python on made graphs."""

import random

import pytest

from ferrycraft.operators import graph as g
from ferrycraft.operators.graph import Reference


def plain_cascade(tables, references, root, asked):
    """The largest set of roots that can go together, by repeated reach."""
    def children(r, keys):
        at = {tuple(row[c] for c in r.parent_columns) for row in tables[r.parent] if row["k"] in keys.get(r.parent, ())}
        return [row["k"] for row in tables[r.table] if tuple(row[c] for c in r.columns) in at
                and None not in [row[c] for c in r.columns]]

    def reach(keys):
        found = {root: set(keys)}
        while True:
            new = {t: set(k) for t, k in found.items()}
            for r in references:
                if r.action == "CASCADE":
                    new.setdefault(r.table, set()).update(children(r, found))
            if new == found:
                return found
            found = new

    roots = {row["k"] for row in tables[root]} & set(asked)
    stays = set()
    while True:
        every = reach(roots - stays)
        late = set()
        for one in roots - stays:
            own = reach({one})
            for r in references:
                held = children(r, own) if r.action in ("RESTRICT", "NO ACTION") else []
                if r.action == "NO ACTION":
                    held = [k for k in held if k not in every.get(r.table, ())]
                if held:
                    late.add(one)
        if not late:
            break
        stays |= late
    changed = {(r.table, k, r.name) for r in references if r.action == "SET NULL"
               for k in children(r, every) if k not in every.get(r.table, ())}
    return {(t, k) for t, ks in every.items() for k in ks}, changed, stays


@pytest.mark.parametrize("seed", range(4))
def test_cascade(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    tables = {t: [{"k": i, "x": rng.choice([None, *range(12)]), "y": rng.choice([None, *range(12)])} for i in range(12)] for t in names}
    kinds = [["CASCADE"], ["CASCADE", "SET NULL"], ["CASCADE", "RESTRICT", "NO ACTION", "SET NULL"]][min(seed, 2)]
    references = [Reference("self", "a", ("x",), "a", ("k",), "CASCADE"), Reference("ba", "b", ("x",), "a", ("k",), "CASCADE"),
                  Reference("cb", "c", ("x",), "b", ("k",), rng.choice(kinds)), Reference("ac", "a", ("y",), "c", ("k",), rng.choice(kinds)),
                  Reference("bb", "b", ("y",), "b", ("k",), rng.choice(kinds))]
    frames = {t: spark.createDataFrame([(r["k"], r["x"], r["y"]) for r in rows], "k int, x int, y int") for t, rows in tables.items()}
    asked = [0, 3, 5, 7, 99]
    out = g.cascade_delete(frames, {t: ["k"] for t in names}, references, "a", spark.createDataFrame([(k,) for k in asked], "k int"))
    key = lambda k: '{"k":%d}' % k
    gone, changed, stays = plain_cascade(tables, references, "a", asked)
    assert {tuple(r) for r in out.deleted.collect()} == {(t, key(k)) for t, k in gone}
    assert {tuple(r)[:3] for r in out.changed.collect()} == {(t, key(k), n) for t, k, n in changed}
    assert {r["key"] for r in out.blocked.collect()} == {key(k) for k in stays}


def test_composite_references_and_what_holds(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "`a.x` int, y int")
    b = spark.createDataFrame([(10, 1, 1), (11, 1, None), (12, 2, 1), (13, 2, 1)], "k int, x int, y int")
    r = Reference("r", "b", ("x", "y"), "a", ("a.x", "y"), "no_action")
    out = g.cascade_delete({"a": a, "b": b}, {"a": ["a.x", "y"], "b": ["k"]}, [r], "a", a)
    assert [tuple(x) for x in out.deleted.collect()] == [("a", '{"a.x":1,"y":2}')]
    assert sorted(tuple(x) for x in out.blocked.collect()) == [
        ('{"a.x":1,"y":1}', "r", "b", '{"k":10}'), ('{"a.x":2,"y":1}', "r", "b", '{"k":12}')]
    with pytest.raises(ValueError):
        g.cascade_delete({"a": a, "b": b}, {"a": ["y"], "b": ["k"]}, [Reference("r", "b", ("x",), "a", ("a.x", "y"))], "a", a)


def plain_order(tables, references):
    edges = {t: {b for a, b in references if a == t and b in tables} for t in tables}

    def reach(t):
        seen, todo = set(), [t]
        while todo:
            for n in edges[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        return seen

    far = {t: reach(t) for t in tables}
    home = {t: min([t, *(n for n in far[t] if t in far[n])]) for t in tables}
    size = {c: sum(h == c for h in home.values()) for c in home.values()}
    level = lambda c: 1 + max([level(home[n]) for t in tables if home[t] == c for n in edges[t] if home[n] != c], default=-1)
    out = []
    for t in tables:
        cyclic = t in far[t]
        out.append((t, level(home[t]), home[t] if cyclic else None, size[home[t]] if cyclic else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, links", [(1, 10), (2, 16), (3, 30)])
def test_load_order(spark, seed, links):
    rng = random.Random(seed)
    tables = [f"t{i}" for i in range(14)]
    references = [(rng.choice(tables), rng.choice([*tables, "unknown"])) for _ in range(links)]
    out = g.load_order(spark.createDataFrame([(t,) for t in tables], "table_name string"),
                       spark.createDataFrame(references, "table_name string, ref_table string"))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain_order(tables, references)


def test_no_references(spark):
    out = g.load_order(spark.createDataFrame([("a",), ("b",)], "table_name string"),
                       spark.createDataFrame([], "table_name string, ref_table string"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 0, None, None), ("b", 0, None, None)]


def test_rounds_of_a_load_order_follow_each_reference_once(spark, monkeypatch):
    """Rows staged over all rounds follow the references, also on a long chain with cycles on it."""
    n = 12
    references = [(f"t{i:03}", f"t{i - 1:03}") for i in range(1, n)] + [(f"t{i:03}", f"t{i + 1:03}") for i in range(3, n, 5)]
    staged, own = [], g.stage

    def counting(df, label="stage"):
        out = own(df, label)
        staged.append((label, out.count()))
        return out

    monkeypatch.setattr(g, "stage", counting)
    tables = spark.createDataFrame([(f"t{i:03}",) for i in range(n)], "table_name string")
    out = g.load_order(tables, spark.createDataFrame(references, "table_name string, ref_table string"))
    cycles = [(i, i + 1) for i in range(3, n - 1, 5)]
    want, level = {}, -1
    for i in range(n):
        pair = next((c for c in cycles if i in c), None)
        level += not (pair and i == pair[1])
        want[f"t{i:03}"] = (level, f"t{pair[0]:03}" if pair else None, 2 if pair else None)
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == want
    assert sum(rows for label, rows in staged if label in ("levels", "met")) <= 2 * n


def test_keys_become_texts_behind_the_join(spark):
    """A round of a cascade writes JSON keys of the rows that it finds, not of whole tables."""
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(10, 1)], "k int, x int")
    work = g._Cascade({"a": a, "b": b}, {"a": ["k"], "b": ["k"]}, [Reference("r", "b", ("x",), "a", ("k",), "CASCADE")])
    found = work.children(work.references[0], g.stage(work.slim("a")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" in plan[:plan.index("Join")] and "StructsToJson" not in plan[plan.index("Join"):]
    assert [r["child_node"] for r in found.collect()] == ['{"k":10}']
