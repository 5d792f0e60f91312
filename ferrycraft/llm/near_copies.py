"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, all of them.

Two searches, each candidate verified on the shingle sets themselves. The first is quick: texts whose SimHash fingerprints
differ in a few bits, found by ``pivot_simhash``; and where edits turn more bits, fingerprints of a few least hashes, by
several orders, of which each text is compared with the first of each of its cells. The second is whole: with shingles in one global order, common ones last, two similar texts share one of
their first few (prefix filtering: Chaudhuri et al., "A primitive operator for similarity joins in data cleaning",
2006; shorter for the smaller text, and with a bound from places: Xiao et al., "Efficient similarity joins for
near-duplicate detection", 2008). It compares only texts that the first search has not joined already, so a large
group of copies isn't compared with itself, and texts that share a template don't meet, as that comes last. Shingles of
frequent words come late too, as many texts share them by chance, so that unrelated texts hardly meet, however many.

Only pairs that odd sketches as long as the texts leave in doubt are verified, and only their texts are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, slots, with_columns
from ferrycraft.llm.components import components
from ferrycraft.llm.pivot_simhash import links
from ferrycraft.llm.son_collocations import bitmap
from ferrycraft.session import settle, stage

SEED = 42
WIDTH = 5
#: Similarity as a fraction, so that bounds are exact.
SIMILAR = 4, 5
#: Bits in which the SimHash fingerprints of candidates differ at most.
RADIUS = 3
#: At similarity 0.8 a pair meets in one of 16 fingerprints of 4 hashes with a probability of 0.9998.
BANDS, LEAST = 16, 4
#: Texts from which common shingles are learned, at most about; those found in so many of them are common; and how many
#: of these are kept. The order decides how much is compared, not what is found.
SAMPLE, COMMON, LISTED = 16384, 3, 1 << 19
#: Words of these texts whose frequency is kept, at most, and steps of a weight for a doubled frequency.
WORDS, STEPS = 1 << 17, 16
#: Bits for each shingle in the sketch that is compared before texts are, at least, but for rounding.
WIDE = 4
#: Shared shingles in front of one that its row tells, so that a pair is reported where it meets first.
BEFORE = 3
#: Rows of shingles that meet at a time whatever the texts' size; more of them meet in up to so many parts.
MANY, PARTS = 1 << 22, 4
#: Shingles hashed in all orders at a time, and pairs looked at at a time.
HASHES, PAIRS = 1 << 11, 1 << 18
#: Bytes of text whose shingles are held at a time, and texts whose first shingles are.
TAKEN_BYTES, TEXTS = 1 << 20, 1 << 10

_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 63, (2 + WIDTH, BANDS * LEAST), dtype=np.uint64)
_FLIPS, _FACTORS = _DRAWN[0][:, None], _DRAWN[1][:, None] * np.uint64(2) + np.uint64(1)
_PLACES = _DRAWN[2:, 0] * np.uint64(2) + np.uint64(1)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return hashes ^ (hashes >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))


def _windows(words: np.ndarray, factors: np.ndarray, width: int) -> np.ndarray:
    width = min(width, len(words))
    count = len(words) - width + 1
    sums = np.full(count, width, np.uint64)
    for place in range(width):
        sums += words[place:place + count] * factors[place]
    return sums


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The distinct hashes of the word shingles, sorted; a text of fewer words is one shingle, without words 0."""
    words = word_hashes(text)
    return np.unique(_mixed(_windows(words, _PLACES, width))) if len(words) else np.zeros(1, np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * shared >= SIMILAR[0] * (len(a) + len(b) - shared)


def simhash(own: np.ndarray) -> np.int64:
    """The 64-bit SimHash of the set: bits set in over half of the hashes; without words 0."""
    total = np.zeros(64, np.int64)
    for low in range(0, len(own), HASHES):
        bits = np.unpackbits(own[low:low + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * total > len(own), bitorder="little").view(np.int64)[0]


def least_hashes(own: np.ndarray) -> np.ndarray:
    """The least hash of the set in each of the orders."""
    least = np.full(BANDS * LEAST, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(own), HASHES):
        np.minimum(least, ((own[None, low:low + HASHES] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    return _mixed(least)


def _cells(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for place in range(LEAST):
        key = _mixed(key * np.uint64(0xD6E8FEB86659FD93) + least.reshape(BANDS, LEAST)[:, place])
    return key


def digest(text: Column) -> Column:
    """What names a text: equal texts share it, NULL as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(digest(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))


@dataclass
class Order:
    """What is known of a sample: ``common`` shingles, sorted, with the number of texts each, and ``words`` with weights."""

    common: np.ndarray
    words: np.ndarray

    def weighed(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the text and, of each, the sum of its words' weights."""
        words = word_hashes(text)
        if not len(words):
            return np.zeros(1, np.uint64), np.zeros(1, np.uint64)
        own, at = np.unique(_mixed(_windows(words, _PLACES, WIDTH)), return_index=True)
        return own, _windows(_known(self.words, words), np.ones(WIDTH, np.uint64), WIDTH)[at]


def _known(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The second row's value of each hash, 0 for those that the first row doesn't hold."""
    if not table.shape[1]:
        return np.zeros(len(hashes), np.uint64)
    at = np.minimum(np.searchsorted(table[0], hashes), table.shape[1] - 1)
    return np.where(table[0][at] == hashes, table[1][at], np.uint64(0))


def common_shingles(named: DataFrame) -> Order:
    """Shingles of several texts of a sample and frequent words: what comes last in the order."""
    share = min(1.0, SAMPLE / max(1, named.count()))
    chosen = named.where(F.pmod(F.xxhash64("node"), F.lit(1 << 40)) < int(share * (1 << 40))).dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, TAKEN_BYTES):
            texts = block.texts()
            for word, parts in (False, map(shingles, texts)), (True, map(word_hashes, texts)):
                own, n = np.unique(np.concatenate([*parts]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([word] * len(own), pa.bool_()), pa.array(own.view(np.int64)), pa.array(n)],
                                                 names=["word", "h", "n"])

    def often() -> DataFrame:
        return chosen.mapInArrow(run, "word boolean, h long, n long").groupBy("word", "h").agg(F.sum("n").alias("n")).where(
            F.col("n") >= COMMON)

    counts = settle(named.sparkSession, often, "sample")

    def most(rows: DataFrame, limit: int) -> np.ndarray:
        rows = rows.orderBy(F.desc("n"), "h").select("h", "n").limit(limit).toArrow()
        found = np.stack([rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy().astype(np.uint64)])
        return found[:, np.argsort(found[0])]

    common, words = most(counts.where("NOT word"), LISTED), most(counts.where("word"), WORDS)
    words[1] = np.rint(STEPS * np.log2(words[1].astype(np.float64)))
    return Order(common, words)


def first_shingles(own: np.ndarray, weights: np.ndarray, order: Order) -> np.ndarray:
    """The shingles one of which any similar text has too: all but the last 0.8 of the set, and one, rare ones first."""
    n, (p, q) = len(own), SIMILAR
    return own[np.lexsort((_mixed(own), weights, _known(order.common, own)))[:n + p * -n // q + 1]]


def odd_sketch(own: np.ndarray) -> np.ndarray:
    """256 bits, each the parity of the shingles that hash to it: sketches of two sets differ in no more bits than the sets
    differ in shingles."""
    odd = np.bincount((own >> np.uint64(7) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(own: np.ndarray) -> bytes:
    """The same with as many bits as the set asks for, a power of two; of two sketches the longer one can be folded."""
    bits = 1 << max(8, (WIDE * len(own) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(7) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_be_similar(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with these wide sketches can be similar; never no for similar ones."""
    p, q = SIMILAR
    if q * min(n, m) < p * max(n, m):
        return False
    x, y = (np.frombuffer(s, np.uint8) for s in (x, y))
    short = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, short), axis=0) for s in (x, y))
    return int(np.bitwise_count(x ^ y).sum()) <= n + m - 2 * (-(-p * (n + m) // (p + q)))


def signatures(named: DataFrame, common: Order) -> DataFrame:
    """``(node, n, print, cells, first, sketch)`` for every distinct text: shingles, SimHash, least hashes, first shingles
    in order."""
    held = named.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, TAKEN_BYTES):
            weighed = [held.value.weighed(t) for t in block.texts()]
            sets = [x for x, _ in weighed]
            yield with_columns(
                block, ["node"], n=pa.array([len(x) for x in sets], pa.int64()),
                print=pa.array([simhash(x) for x in sets], pa.int64()),
                cells=pa.array([_cells(least_hashes(x)).view(np.int64) for x in sets], pa.list_(pa.int64())),
                first=pa.array([first_shingles(x, w, held.value).view(np.int64) for x, w in weighed], pa.list_(pa.int64())),
                sketch=pa.array([odd_sketch(x) for x in sets], pa.list_(pa.int64())))

    made = "node binary, n long, print long, cells array<long>, first array<long>, sketch array<long>"
    return named.mapInArrow(run, made).dropDuplicates(["node"])


def simhash_pairs(marked: DataFrame) -> DataFrame:
    """``(a, b)``: pairs that connect all texts whose fingerprints are linked at ``RADIUS`` bits or fewer."""
    prints = marked.groupBy("print").agg(F.min("id").alias("node"), F.count("*").alias("size"))
    same = marked.select("id", "print").join(prints.where("size > 1").select("print", "node"), "print").where("id <> node")
    return same.select(F.col("id").alias("a"), F.col("node").alias("b")).union(
        links(stage(prints.select("print", "node"), "prints"), RADIUS)).distinct()


def leader_pairs(marked: DataFrame) -> DataFrame:
    """``(a, b)``: each text with the first text of each cell that it is in."""
    cells = marked.select("id", F.explode("cells").alias("cell"))
    leaders = cells.groupBy("cell").agg(F.min("id").alias("b"), F.count("*").alias("size")).where("size > 1").drop("size")
    return cells.join(leaders, "cell").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _packed(n: np.ndarray, place: np.ndarray, known: np.ndarray) -> np.ndarray:
    return n << 32 | place << 2 | known


def _meetings(rows: DataFrame) -> DataFrame:
    """``(a, b)`` of texts of different groups that may be similar, from rows of one shingle each.

    The smaller text must hold the shingle among its first ninth or so (``own``); sizes and places must leave room for
    enough shared shingles from there on; and the sketches must not differ in more bits than similar sets may in shingles.
    Texts that share one of the ``BEFORE`` shingles in front have met there, with more room, and aren't told again.
    """
    p, q = SIMILAR

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, group, node, packed, *more = rows
        sketch, before = more[:4], more[4:]
        n, place, known = packed >> 32, packed >> 2 & (1 << 30) - 1, packed & 3
        own = place < n - (2 * p * n + p + q - 1) // (p + q) + 1
        ends = np.searchsorted(rows[0], rows[0], "right")
        # groups are runs inside a shingle's rows; a row meets all rows behind its group's
        change = np.ones(len(group) + 1, bool)
        change[1:-1] = (group[1:] != group[:-1]) | (rows[0][1:] != rows[0][:-1])
        edges = np.flatnonzero(change)
        behind = np.repeat(edges[1:], np.diff(edges))
        count = ends - behind
        total, low = np.concatenate([[0], np.cumsum(count)]), 0
        while low < len(group):
            high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, "right")) - 1)
            a = np.repeat(np.arange(low, high), count[low:high])
            starts = np.cumsum(count[low:high]) - count[low:high]
            b = behind[a] + np.arange(len(a)) - np.repeat(starts, count[low:high])
            swap = (n[a] > n[b]) | ((n[a] == n[b]) & (node[a] > node[b]))
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            room = 1 + np.minimum(n[a] - 1 - place[a], n[b] - 1 - place[b])
            kept = own[a] & (q * n[a] >= p * n[b]) & ((p + q) * room >= p * (n[a] + n[b]))
            a, b = a[kept], b[kept]
            apart = np.zeros(len(a), np.int64)
            for word in sketch:
                apart += np.bitwise_count((word[a] ^ word[b]).view(np.uint64))
            both = n[a] + n[b]
            kept = apart <= both - 2 * (-(-p * both // (p + q)))
            a, b = a[kept], b[kept]
            met = np.zeros(len(a), bool)
            for i, x in enumerate(before):
                for j, y in enumerate(before):
                    met |= (x[a] == y[b]) & (known[a] > i) & (known[b] > j)
            a, b = a[~met], b[~met]
            if len(a):
                met = np.unique(np.stack([node[a], node[b]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(met[:, 0]), pa.array(met[:, 1])], names=["a", "b"])
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((8 + BEFORE, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            if not rows.shape[1]:
                continue
            last = int(np.searchsorted(rows[0], rows[0, -1], "left"))  # the last shingle may go on in the next batch
            yield from pairs(rows[:, :last])
            rest = rows[:, last:]
        yield from pairs(rest)

    spread = rows.repartition(slots(rows), "h").sortWithinPartitions("h", "component")
    return spread.mapInArrow(run, "a long, b long")


def _first_rows(texts: DataFrame, known: Broadcast, part: int, parts: int) -> DataFrame:
    """A row for each of the first shingles that ``known`` holds, with what ``_meetings`` asks for; one part of them."""
    names = ["h", "component", "id", "packed", *(f"s{i}" for i in range(4)), *(f"b{i}" for i in range(BEFORE))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(low, TEXTS) for b in batches for low in range(0, len(b), TEXTS)):
            hashes, bounds = batch.column(4).flatten().to_numpy(), batch.column(4).offsets.to_numpy()
            bounds = bounds - bounds[0]
            at = np.repeat(np.arange(len(batch)), np.diff(bounds))
            kept = known.value.has(hashes.view(np.uint64))
            place = (np.arange(len(hashes)) - bounds[at])[kept]
            hashes, at = hashes[kept], at[kept]
            nth = np.arange(len(at)) - np.searchsorted(at, at, "left")  # the shared ones in front in the same text
            before = [np.concatenate([np.zeros(i, np.int64), hashes])[:len(hashes)] for i in range(1, BEFORE + 1)]
            own = (hashes.view(np.uint64) >> np.uint64(32)) % np.uint64(parts) == part
            component, ids, n = (batch.column(i).to_numpy()[at] for i in (0, 1, 2))
            sketch = batch.column(3).flatten().to_numpy().reshape(-1, 4)[at].T
            columns = [hashes, component, ids, _packed(n, place, np.minimum(nth, BEFORE)), *sketch, *before]
            yield pa.RecordBatch.from_arrays([pa.array(c[own]) for c in columns], names=names)

    return texts.select("component", "id", "n", "sketch", "first").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def apart_pairs(marked: DataFrame, found: DataFrame) -> DataFrame:
    """``(a, b)`` of texts in different groups of ``found`` that share one of their first shingles.

    Where many rows of shingles are to meet, for the size of the texts, they do so in several parts, one after the other.
    """
    (p, q), spark = SIMILAR, marked.sparkSession
    texts = marked.select("id", "n", "first", "sketch").join(found, F.col("id") == F.col("node"), "left").select(
        "id", "n", "first", "sketch", F.coalesce("component", "id").alias("component"))
    own = F.expr(f"place < n - ({2 * p} * n + {p + q - 1}) div {p + q} + 1")
    each = texts.select("component", "n", F.posexplode("first").alias("place", "h"))
    shared = settle(spark, lambda: each.groupBy("h").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max(own.cast("int")).alias("own"),
        F.count("*").alias("rows")).where("low <> high AND own = 1").select("h", "rows"), "shared")
    count, rows = shared.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    known = spark.sparkContext.broadcast(bitmap(shared, count))
    if rows <= MANY:
        return _meetings(_first_rows(texts, known, 0, 1)).distinct()
    parts = -(-PARTS * rows // marked.agg(F.sum(F.size("first"))).first()[0])
    told = [settle(spark, lambda: _meetings(_first_rows(texts, known, part, parts)).distinct(), "pairs") for part in range(parts)]
    return reduce(DataFrame.union, told).distinct()


def among(hashes: DataFrame) -> Callable[[Column], Column]:
    """Tells of a hash if it is in the ``h`` column: yes for all that are and for few others. The bitmap's size is bounded."""
    known = hashes.sparkSession.sparkContext.broadcast(bitmap(hashes, hashes.count()))

    @F.arrow_udf("boolean")
    def has(h: pa.Array) -> pa.Array:
        return pa.array(known.value.has(h.to_numpy().view(np.uint64)))

    return has


def _ends(named: DataFrame, marked: DataFrame, pairs: DataFrame, make: Callable, made: str) -> DataFrame:
    """``made`` columns that ``make`` yields of the texts in ``pairs``, which a bitmap tells but for few others, by id."""
    ends = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(
        marked.select("id", "node"), "id").select("node", "id"), "ends")
    known = named.sparkSession.sparkContext.broadcast(bitmap(ends.select(F.xxhash64("node").alias("h")), ends.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch.filter(pa.array(known.value.has(batch.column(2).to_numpy().view(np.uint64)))))

    hashed = named.select("node", "text", F.xxhash64("node").alias("h"))
    return hashed.mapInArrow(run, f"node binary, {made}").dropDuplicates(["node"]).join(ends, "node").drop("node")


def _both(pairs: DataFrame, each: DataFrame) -> DataFrame:
    """The pairs with what ``each`` has of ``a`` as the struct ``x``, and of ``b`` as ``y``."""
    held = each.select("id", F.struct(*(c for c in each.columns if c != "id")).alias("of"))
    one = pairs.join(held.select(F.col("id").alias("a"), F.col("of").alias("x")), "a")
    return one.join(held.select(F.col("id").alias("b"), F.col("of").alias("y")), "b").select("a", "b", "x", "y")


def likely(named: DataFrame, marked: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose wide sketches don't differ in more bits than similar sets may in shingles."""

    def sketched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block in blocks([batch], TAKEN_BYTES):
            sets = [shingles(t) for t in block.texts()]
            yield with_columns(block, ["node"], n=pa.array([len(x) for x in sets], pa.int64()),
                               sketch=pa.array([wide_sketch(x) for x in sets], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (n, x), (m, y) = ([c.to_pylist() for c in batch.column(i).flatten()] for i in (2, 3))
            kept = [may_be_similar(*each) for each in zip(n, x, m, y)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    sketches = stage(_ends(named, marked, pairs, sketched, "n long, sketch binary"), "sketches")
    return _both(pairs, sketches).mapInArrow(run, "a long, b long")


def verified(named: DataFrame, marked: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of ids whose texts are similar."""
    pairs = settle(named.sparkSession, lambda: likely(named, marked, pairs), "likely")
    texts = stage(_ends(named, marked, pairs, lambda batch: [batch.select(["node", "text"])], "text string"), "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(64)(shingles)
        for batch in batches:
            (x,), (y,) = (batch.column(i).flatten() for i in (2, 3))
            kept = [similar(known(x[i].as_py().encode()), known(y[i].as_py().encode())) for i in range(len(batch))]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return _both(pairs, texts).mapInArrow(run, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """``(node, component)`` of every text that is a near copy of another: the first text reachable over near copies.

    Texts count once, whatever rows hold them. Texts without words are near copies of each other; texts of fewer than
    five words are near copies when their words are the same; case and white space don't count. No pair is left out.
    Each step's tables and shuffle files go when the step ends, all others at the end.
    """
    named, spark = _named(docs), docs.sparkSession

    def quick(marked: DataFrame) -> DataFrame:
        met = simhash_pairs(marked).union(leader_pairs(marked)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return verified(named, marked, stage(met.distinct(), "pairs"))

    def rest(marked: DataFrame, joined: DataFrame) -> DataFrame:
        return verified(named, marked, settle(spark, lambda: apart_pairs(marked, joined), "pairs"))

    def found() -> DataFrame:
        marked = settle(spark, lambda: signatures(named, common_shingles(named)).withColumn(
            "id", F.monotonically_increasing_id()), "signatures")
        near = settle(spark, lambda: quick(marked), "links")
        joined = settle(spark, lambda: components(near), "joined")
        near = near.union(settle(spark, lambda: rest(marked, joined), "links"))
        homes = settle(spark, lambda: components(near), "joined").withColumnsRenamed({"node": "id"})
        names = marked.select("id", "node")
        return homes.join(names, "id").join(names.select(F.col("id").alias("component"), F.col("node").alias("first")),
                                            "component").select("node", F.col("first").alias("component"))

    return settle(spark, found, "near_copies")


def first_of_each(docs: DataFrame, key: str) -> DataFrame:
    """Of every group of near copies the row with the least ``key``, then the least digest of its text; no key is NULL.

    Rows that are alone in their group are passed on as they are read; few others than the rest are shuffled.
    """
    rows = docs.select(F.struct("*").alias("doc"), digest(F.col("text")).alias("own")).withColumn("key", F.col("doc")[key])

    def placed() -> DataFrame:
        texts = rows.groupBy("own").agg(F.min("key").alias("key"), F.count("*").alias("n"))
        homes = stage(texts.join(groups(docs), F.col("own") == F.col("node"), "left").select(
            "own", "key", "n", F.coalesce("component", "own").alias("home")), "homes")
        firsts = homes.groupBy("home").agg(F.min(F.struct("key", "own")).alias("first"), F.sum("n").alias("rows"))
        return homes.select("own", "home").join(firsts, "home").select("own", "first", "rows")

    homes = settle(docs.sparkSession, placed, "homes")
    has = among(homes.where("rows > 1").select(F.xxhash64("own").alias("h")))(F.xxhash64("own"))
    firsts = homes.where("own = first.own").select(F.col("own").alias("of"), F.col("first.key").alias("least"))
    several = rows.where(has).dropDuplicates(["own", "key"])
    one = several.join(firsts, (F.col("own") == F.col("of")) & (F.col("key") == F.col("least")))
    return rows.where(~has).select("doc").union(one.select("doc"))
