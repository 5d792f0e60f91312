"""SimHash near-duplicates, searched through pivot distance tables.

A fingerprint's row of the table holds its Hamming distances to reference fingerprints. By the triangle
inequality two fingerprints at distance r differ by at most r in every coordinate. The first references are zero
and the masks of two-bit fields, so differences of coordinates count the bits of a field: at distance r at most r
fields differ. Fields are dealt to ``groups`` and pairs meet in a cell when all groups but r agree. In a cell,
pairs whose coordinates differ by more than r anywhere are discarded and the survivors are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, slots, texts_of, with_columns
from ferrycraft.llm.components import components
from ferrycraft.session import stage

SEED = 42
BITS = 64
FIELD = 2
#: Shingle hashes counted at a time, for bounded memory on very long texts.
HASHES = 1 << 15
#: A cell with more fingerprints is searched by exact bit groups of bounded size instead.
CELL_LIMIT = 16384
#: Pairs compared at a time.
PAIRS = 1 << 20


def references(extra: int = 31) -> np.ndarray:
    """Zero, the masks of all two-bit fields, and ``extra`` spread-out words from a fixed generator."""
    masks = [3 << (FIELD * i) for i in range(BITS // FIELD)]
    spread = np.random.default_rng(SEED).integers(0, 1 << 63, extra, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return np.concatenate([np.array([0, *masks], np.uint64), spread])


def distance_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, one row for each fingerprint and one column for each reference."""
    return np.bitwise_count(prints[:, None] ^ pivots[None, :]).astype(np.int8)


def fingerprint(text: bytes, width: int) -> int:
    """Bits set in over half of the hashes of the word shingles, repeats included; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return digest(b" ".join(words), SEED)
    count, total = len(words) - width + 1, np.zeros(BITS, np.int64)
    joined, shape = zip(*(words[i:] for i in range(width))), b" ".join([b"%b"] * width)
    for low in range(0, count, HASHES):
        n = min(HASHES, count - low)
        hashes = np.fromiter((digest(shape % next(joined), SEED) for _ in range(n)), np.uint64, n)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", width: int = 3) -> DataFrame:
    """``(key, print)``: the 64-bit SimHash of every text as a signed long; NULL and wordless texts give 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            prints = np.array([fingerprint(t, width) for t in block.texts()], np.uint64)
            yield with_columns(block, [key], print=prints.view(np.int64))

    source = texts_of(docs, key)
    return source.mapInArrow(run, source.select(key, F.lit(0).cast("long").alias("print")).schema)


def _cell_keys(prints: np.ndarray, radius: int, groups: int) -> np.ndarray:
    """A key for each choice of the groups that must agree, from field counts read off the distance table."""
    pivots = references(0)
    table = distance_table(prints, pivots)
    fields = (table[:, :1] + FIELD - table[:, 1:]) // 2
    keys = []
    for chosen in combinations(np.array_split(np.arange(BITS // FIELD), groups), groups - radius):
        key = np.full(len(prints), len(keys), np.uint64)
        for field in np.concatenate(chosen):
            key = key * np.uint64(3) + fields[:, field].astype(np.uint64)
        keys.append(key)
    return np.stack(keys, axis=1)


def _exact_keys(prints: np.ndarray, radius: int) -> np.ndarray:
    """A key for each choice of nibbles that must agree; so many bits are fixed that a cell's size is bounded."""
    nibbles = [np.uint64(15 << (4 * i)) for i in range(16)]
    keys = []
    for left_out in combinations(nibbles, radius):
        mask = ~np.bitwise_or.reduce(left_out)
        mixed = (prints & mask) * np.uint64(0x9E3779B97F4A7C15)
        keys.append((mixed ^ (mixed >> np.uint64(29))) + np.uint64(len(keys)))
    return np.stack(keys, axis=1)


def _keyed(prints: DataFrame, radius: int, groups: int | None) -> DataFrame:
    """``(cell, print, node)``, a row for every cell of every fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, node = (batch.column(i).to_numpy() for i in (0, 1))
            keys = (_exact_keys(own.view(np.uint64), radius) if groups is None
                    else _cell_keys(own.view(np.uint64), radius, groups))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.T.ravel().view(np.int64)), pa.array(np.tile(own, keys.shape[1])),
                 pa.array(np.tile(node, keys.shape[1]))], names=["cell", "print", "node"])

    return prints.select("print", "node").mapInArrow(run, "cell long, print long, node long")


def close_pairs(cells: np.ndarray, prints: np.ndarray, radius: int,
                pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of one cell within ``radius`` bits; rows come sorted by cell.

    Rows are compared with the one ``step`` below them while any cell is that long, so memory follows the rows.
    """
    table = distance_table(prints, pivots)
    ends = np.searchsorted(cells, cells, "right")
    left = np.flatnonzero(ends - np.arange(len(cells)) > 1)
    step = 1
    while len(left):
        for low in range(0, len(left), PAIRS):
            a = left[low:low + PAIRS]
            b = a + step
            for column in table.T:  # the table is read column by column, each one over fewer survivors
                near = np.abs(column[a] - column[b]) <= radius
                a, b = a[near], b[near]
            true = np.bitwise_count(prints[a] ^ prints[b]) <= radius
            if true.any():
                yield a[true], b[true]
        step += 1
        left = left[left + step < ends[left]]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n positions the least position that links reach."""
    low = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = low[a], low[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(low, np.maximum(ra, rb), np.minimum(ra, rb))
            while (flat := low[low] < low).any():
                low[flat] = low[low[flat]]
    return low


def _linked(keyed: DataFrame, radius: int) -> DataFrame:
    """``(a, b)``: in every cell, each linked node with one it is linked to; cells are read as sorted runs."""

    def links(cells: np.ndarray, prints: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        alone = np.ones(len(cells), bool)
        same = cells[1:] == cells[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        cells, prints, nodes = cells[~alone], prints[~alone].view(np.uint64), nodes[~alone]
        low = forest(len(cells), close_pairs(cells, prints, radius, references()))
        at = np.flatnonzero(low < np.arange(len(low)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[low[at]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1], "left"))  # the last cell may go on in the next batch
            yield links(*(r[:last] for r in rows))
            rest = [r[last:] for r in rows]
        yield links(*rest)

    spread = keyed.repartition(slots(keyed), "cell").sortWithinPartitions("cell")
    return spread.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, radius: int = 2, groups: int = 6, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``(a, b)`` node pairs that connect all fingerprints linked at ``radius`` bits or fewer.

    ``prints`` holds distinct ``print`` values, each with a ``node``. Every pair within the radius meets in a
    cell; of a cell's links a spanning forest is kept, which loses no connection. A cell of over ``cell_limit``
    fingerprints is not gathered: its members are dealt out again by all choices of 16 - radius agreeing nibbles,
    whose cells hold at most 16 ** radius fingerprints.
    """
    keyed = _keyed(prints, radius, groups)
    hot = stage(keyed.groupBy("cell").count().where(F.col("count") > cell_limit).select("cell"), "hot_cells")
    if hot.isEmpty():
        return _linked(keyed, radius)
    members = keyed.join(hot, "cell", "left_semi").select("print", "node").distinct()
    dealt = _keyed(members, radius, None)
    return _linked(keyed.join(hot, "cell", "left_anti"), radius).union(_linked(dealt, radius))


def simhash_components(docs: DataFrame, key: str = "doc_id", width: int = 3, radius: int = 2, groups: int = 6,
                       cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``(key, print, component_id)`` for every row: the least key reachable over fingerprints ``radius`` bits apart.

    Equal fingerprints are one node, so copies cost one row in the search whatever their number. NULL, empty and
    wordless texts have fingerprint 0 and link like any other; rows with equal keys count each; a NULL key keeps
    its fingerprint and takes the component of that fingerprint's least key; an empty table gives no rows; further
    columns are ignored.
    """
    marked = stage(fingerprints(docs, key, width), "fingerprints")
    prints = marked.groupBy("print").agg(F.min(key).cast("long").alias("node"))
    found = components(links(prints.where("node is not null"), radius, groups, cell_limit))
    homes = prints.join(found, "node", "left").select(
        F.col("print").alias("own"), F.coalesce("component", "node").alias("component_id"))
    return marked.join(homes, F.col("print") == F.col("own")).select(key, "print", "component_id")
