"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside a cell, one representative a group.

Cells are fitted on a bounded sample; every vector then lives in the cell of its nearest centroid. A vector also visits
the cells of lower number that a vector linked to it could live in: one behind a bisecting hyperplane no farther than
the angle of the threshold. So every linked pair meets in one cell exactly, whatever the centroids are like. A cell may
have a core, a point with the vectors within half the angle around it: those are all linked with each other and are
counted, not compared. What else lives in a cell, and its visitors, are multiplied with the cell's residents block by
block, so a task holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import hashed_sample, slots
from ferrycraft.llm.components import components
from ferrycraft.llm.pivot_simhash import forest
from ferrycraft.session import stage

SEED = 42
#: Vectors that cells are fitted on, at most about; vectors a cell is meant to hold; and cells, at most.
SAMPLE, CELL, CELLS = 8192, 1024, 256
ROUNDS = 10
#: Residents multiplied at a time, and vectors multiplied with them at a time.
BLOCK, QUERIES = 4096, 512
#: Members of a sampled cell that its core is looked for among.
CORE_SEARCH = 1024
#: Angles (radians) and cosines are trusted to this; pairs are decided by the product alone.
SLACK = 1e-9


def normed(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; components are scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors: each point goes to the centroid of largest product, sums are scaled to length 1."""
    rng = np.random.default_rng(SEED)
    centroids = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        home = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        length = np.linalg.norm(sums, axis=1)
        alive = length > 0  # an empty cell keeps its centroid
        centroids[alive] = sums[alive] / length[alive, None]
    return np.unique(centroids, axis=0)


def cores(points: np.ndarray, centroids: np.ndarray, similar: float) -> np.ndarray:
    """For each cell the middle of the sampled members around the one with the most linked members."""
    home, found = (points @ centroids.T).argmax(axis=1), centroids.copy()
    for cell in range(len(centroids)):
        own = points[home == cell][:CORE_SEARCH]
        if len(own):
            near = own @ own.T >= similar
            middle = own[near[near.sum(axis=1).argmax()]].sum(axis=0)
            found[cell] = middle / np.linalg.norm(middle)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(units: DataFrame, similar: float, n: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Centroids and cores from a sample of distinct vectors, those of the commonest length; ``None`` without vectors."""
    sample = hashed_sample(units.select("embedding"), "embedding", SAMPLE).toArrow().column(0).combine_chunks()
    rows = sample.to_pylist()
    if not rows:
        return None
    sizes, counts = np.unique([len(r) for r in rows], return_counts=True)
    size = sizes[counts.argmax()]
    # rows come in any order from tasks: sorted, so that every run fits the same cells
    points = normed(np.array(sorted(r for r in rows if len(r) == size), float))
    centroids = spherical_kmeans(points, max(1, min(len(points), n // CELL, CELLS)))
    return centroids, cores(points, centroids, similar)


def _assigned(units: DataFrame, fitted: tuple[np.ndarray, np.ndarray] | None, similar: float) -> DataFrame:
    """The units with ``cell``, ``core`` and the ``visits``; vectors of another length than the fitted ones are in cell -1."""
    angle = np.arccos(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            n = len(vectors)
            cell, core, visits = np.full(n, -1), np.zeros(n, bool), [[] for _ in range(n)]
            lengths = np.diff(vectors.offsets.to_numpy())
            held = np.flatnonzero(lengths == fitted[0].shape[1]) if fitted else np.zeros(0, int)
            if len(held):
                centroids, middles = fitted
                apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
                np.fill_diagonal(apart, 1)
                points = normed(_matrix(vectors.take(pa.array(held))))
                products = points @ centroids.T
                home = products.argmax(axis=1)
                cell[held] = home
                near = np.arccos(np.clip((points * middles[home]).sum(axis=1), -1, 1))
                core[held] = near <= angle / 2 - 1e-6
                behind = (products[np.arange(len(held)), home][:, None] - products) / apart[home]
                rows, cells = np.nonzero((behind <= np.sin(angle) + SLACK)
                                         & (np.arange(len(centroids))[None, :] < home[:, None]))
                for row, other in zip(held[rows].tolist(), cells.tolist()):
                    visits[row].append(other)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(core),
                                              pa.array(visits, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "cell", "core", "visits"])

    schema = units.select("*", F.lit(0).alias("cell"), F.lit(True).alias("core"),
                          F.array(F.lit(0)).alias("visits")).schema
    return units.mapInArrow(run, schema)


def _products(dealt: DataFrame, similar: float) -> DataFrame:
    """``(unit, links, of)`` from blocks with the vectors that ask: rows linked, and units with one they are linked to.

    Rows come sorted by block, residents first. Both sides of a pair count it, but where a resident asks too: it is
    counted for the side that asks, and for a core resident, which doesn't ask.
    """
    names = ["unit", "links", "of"]

    def asked(base: dict, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        unit, weight, visitor = (rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                 for c in ("unit", "mult", "visitor"))
        points = normed(_matrix(rows.column(rows.schema.get_field_index("embedding"))))
        for low in range(0, len(unit), QUERIES):
            part = slice(low, low + QUERIES)
            near = points[part] @ base["points"].T >= similar
            near &= unit[part, None] != base["unit"][None, :]
            if not near.any():
                continue
            own = near @ base["weight"]
            back = (near & (visitor[part, None] | base["core"][None, :])).T @ weight[part]
            ends = np.concatenate([unit[part], base["unit"]])
            a, b = np.nonzero(near)
            low_end = forest(len(ends), [(a, b + len(own))])
            linked = np.flatnonzero(np.concatenate([near.any(axis=1), near.any(axis=0)]))
            yield pa.RecordBatch.from_arrays([
                pa.array(ends[linked]), pa.array(np.concatenate([own, back])[linked]),
                pa.array(ends[low_end[linked]])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, base = None, [], None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, high in zip(starts := [0, *(np.flatnonzero(np.diff(keys)) + 1)], [*starts[1:], len(keys)]):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                if block != keys[low]:
                    block, held, base = keys[low], [], None
                asks = rows.column(1).to_numpy(zero_copy_only=False)
                split = int(np.searchsorted(asks, True))
                if split:
                    held.append(rows.slice(0, split))
                if split < len(rows):
                    if base is None and held:
                        whole = pa.Table.from_batches(held).combine_chunks()
                        base = {"unit": whole["unit"].to_numpy(), "weight": whole["mult"].to_numpy(),
                                "core": whole["core"].to_numpy(),
                                "points": normed(_matrix(whole["embedding"].combine_chunks()))}
                        held = []
                    if base is not None:
                        yield from asked(base, rows.slice(split))

    spread = dealt.select("block", "asks", "visitor", "core", "unit", "mult", "embedding").repartition(
        slots(dealt), "block").sortWithinPartitions("block", "asks")
    return spread.mapInArrow(run, "unit long, links long, of long")


def link_vectors(vectors: DataFrame, key: str = "vec_id", label: str = "label", embedding: str = "embedding",
                 similar: float = 0.98, block: int = BLOCK) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row: rows with an equal, non-NULL label are linked at a cosine of
    ``similar`` or more, in double precision.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the least key reachable over links, itself
    included, and ``kept`` says whether it is the row's own. Rows without label, and vectors that are NULL, empty, zero
    or hold NULL, NaN or infinite components, link with nothing; so do vectors of different lengths. Equal vectors are
    one unit of the search, whatever their number. Rows with equal keys count each; a NULL key is no component's least
    and is never kept; an empty table gives no rows; further columns are ignored. All linked pairs are found; the fit on
    a sample decides only how fast.
    """
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = stage(rows.withColumn("usable", usable), "vectors")
    units = rows.where("usable").groupBy("label", "embedding").agg(F.min("id").alias("least"), F.count("*").alias("mult"))
    units = stage(units.withColumn("unit", F.monotonically_increasing_id()), "units")  # numbers are pinned by the table
    placed = stage(_assigned(units.withColumn("size", F.size("embedding")), fit(units, similar, units.count()), similar),
                   "placed")
    home = ["label", "size", "cell"]
    core = stage(placed.where("core").groupBy(home).agg(F.sum("mult").alias("core_mult"), F.min("unit").alias("core_unit")),
                 "cores")
    hot = placed.groupBy(home).count().where(F.col("count") > block).select(
        *home, F.ceil(F.col("count") / block).cast("int").alias("parts"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}")) for c in home]
    asking = placed.where("NOT core").select("unit", "mult", "embedding", *home, F.lit(False).alias("visitor")).union(
        placed.select("unit", "mult", "embedding", "label", "size", F.explode("visits").alias("cell"), F.lit(True)))
    held = placed.alias("p").join(stage(hot, "hot_cells").alias("h"), same, "left").select(
        "p.*", F.pmod(F.xxhash64("p.unit"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    asked = asking.alias("p").join(stage(hot, "hot_cells").alias("h"), same, "left").select(
        "p.*", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    key_of = F.xxhash64("label", "size", "cell", "part")
    dealt = held.select(key_of.alias("block"), F.lit(False).alias("asks"), F.lit(False).alias("visitor"), "core", "unit",
                        "mult", "embedding").union(
        asked.select(key_of, F.lit(True), "visitor", F.lit(False), "unit", "mult", "embedding"))
    found = stage(_products(dealt, similar), "links")
    inner = placed.where("core").alias("p").join(core.alias("h"), same).select(
        "unit", (F.col("core_mult") - F.col("mult")).alias("links"), F.col("core_unit").alias("of"))
    links = found.union(inner)
    reach = components(links, "unit", "of")
    counted = links.groupBy("unit").agg(F.sum("links").alias("others"))
    own = units.join(counted, "unit", "left").join(reach, F.col("unit") == F.col("node"), "left").select(
        "label", "embedding", "least", "unit", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("component", "unit").alias("component"))
    own = stage(own, "linked")
    least = own.groupBy("component").agg(F.min("least").alias("component_id"))
    marked = own.join(least, "component").select(
        F.col("label").alias("its_label"), F.col("embedding").alias("its_embedding"), "n_links", "component_id")
    out = rows.where("usable").join(marked, (F.col("label") == F.col("its_label"))
                                    & (F.col("embedding") == F.col("its_embedding")), "left")
    out = out.select("id", "n_links", "component_id").union(
        rows.where("NOT usable").select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias(key), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
