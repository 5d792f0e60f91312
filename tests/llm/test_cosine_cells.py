import math

import numpy as np
import pytest
from edge import rows, with_clashes
from pyspark.sql import functions as F

from ferrycraft.llm import cosine_cells as c

NAN, INF = float("nan"), float("inf")


def plain(table):
    """By all pairs, in the order of the rows."""
    def usable(v, label):
        return label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        x, y = (np.array(v) / max(abs(e) for e in v) for v in (a, b))
        return float(x @ y) / math.sqrt(float(x @ x)) / math.sqrt(float(y @ y))

    n = len(table)
    near = [[i != j and usable(table[i][1], table[i][2]) and usable(table[j][1], table[j][2])
             and table[i][2] == table[j][2] and len(table[i][1]) == len(table[j][1])
             and cosine(table[i][1], table[j][1]) >= 0.98 for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            at = todo.pop()
            new = {j for j in range(n) if near[at][j]} - seen
            seen |= new
            todo += new
        least = min((table[j][0] for j in seen if table[j][0] is not None), default=None)
        out.append((table[i][0], sum(near[i]), least, table[i][0] is not None and table[i][0] == least))
    return sorted(out, key=repr)


def made(seed, n=300, size=8, hot=0.4, labels=(1, 1, 1, 2, None)):
    """Spread-out vectors, a hot ball, chains of near ones, exact and scaled copies."""
    rng = np.random.default_rng(seed)
    middle, last, out = rng.normal(size=size), rng.normal(size=size), []
    for i in range(n):
        draw = rng.random()
        if draw < hot:
            v = middle + rng.normal(size=size) * 0.09
        elif draw < hot + 0.3:
            v = last = last + rng.normal(size=size) * 0.08
        elif draw < hot + 0.4 and out:
            v = np.array(out[rng.integers(len(out))][1]) * rng.choice([1, 1, 2])
        else:
            v = rng.normal(size=size)
        out.append((int(i * 7 % n), v.tolist(), labels[int(rng.integers(len(labels)))]))
    return out


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("cell, block", [(c.CELL, c.BLOCK), (20, 16), (4, 50)])
def test_all_links(spark, monkeypatch, cell, block, size=8):
    monkeypatch.setattr(c, "CELL", cell)
    monkeypatch.setattr(c, "QUERIES", 32)
    table = made(cell + size, size=size)
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert rows(c.link_vectors(df, block=block), "*") == plain(table)


def test_links_in_the_plane(spark, monkeypatch):
    """In two dimensions nearly all vectors lie close to a border of cells."""
    monkeypatch.setattr(c, "CELL", 10)
    table = made(2, size=2)
    assert rows(c.link_vectors(spark.createDataFrame(table, SCHEMA), block=40), "*") == plain(table)


def test_cells_are_fitted():
    rng = np.random.default_rng(3)
    heads = c.normed(rng.normal(size=(5, 16)))
    points = c.normed(np.repeat(heads, 60, axis=0) + rng.normal(size=(300, 16)) * 0.01)
    found = c.spherical_kmeans(points, 5, 30)
    assert np.allclose(np.linalg.norm(found, axis=1), 1) and (points @ found.T).max(axis=1).mean() > 0.8


def test_edges(spark):
    """NULL, empty, zero and non-finite vectors, NULL labels and keys, repeated keys and rows, lengths, clashing columns."""
    table = [(1, None, 1), (2, [], 1), (3, [0.0, -0.0], 1), (4, [1.0, None], 1), (5, [NAN, 1.0], 1), (6, [INF, 1.0], 1),
             (7, [1.0, 0.1], None), (8, [1.0, 0.1], 1), (8, [1.0, 0.1], 1), (9, [3e200, 3e199], 1), (10, [1e-300, 1e-301], 1),
             (None, [1.0, 0.0], 1), (11, [1.0, 0.1], 2), (12, [1.0, 0.1, 0.0], 1), (13, [-1.0, -0.1], 1), (8, [0.0, 5.0], 1),
             (0, [0.0, 1.0], 1), (None, [5.0, 5.0], 3), (20, [0.0, 0.0], None)]
    df = with_clashes(spark.createDataFrame(table, "vec_id long, embedding array<double>, `its.label` int"))
    assert rows(c.link_vectors(df.repartition(2), label="its.label"), "*") == plain(table)
    assert c.link_vectors(df.limit(0)).collect() == []
    assert c.link_vectors(df.where("`its.label` IS NULL"), label="its.label").count() == 2


def test_floats_and_text_labels(spark):
    df = spark.createDataFrame([(1, [1.0, 0.5], "a"), (2, [1.0, 0.5001], "a"), (3, [1.0, 0.5], "b")],
                               "vec_id long, embedding array<float>, label string")
    assert rows(c.link_vectors(df), "*") == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_hot_group_is_counted_not_compared(spark, monkeypatch):
    """Members of a core never ask, so what is multiplied doesn't grow with the square of a hot group."""
    rng = np.random.default_rng(4)
    middle = rng.normal(size=32)
    table = [(i, (middle + rng.normal(size=32) * 0.02).tolist(), 1) for i in range(600)]
    df = spark.createDataFrame(table, SCHEMA)
    units = df.select(F.monotonically_increasing_id().alias("unit"), "embedding")
    placed = c._assigned(units, c.fit(units, 0.98, 600), 0.98)
    assert placed.where("core").count() > 590
    out = c.link_vectors(df)
    assert {(r["n_links"], r["component_id"]) for r in out.collect()} == {(599, 0)}
