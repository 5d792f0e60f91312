"""Removal of long strings that occur more than once, by hash-compared suffix sorting of anchored contexts.

1. In every window of ``span`` bytes the gram with the least hash is its anchor. Equal windows have equal anchors
   at equal places, so windows can be equal only under the same gram. Grams that stand at one anchor only go.
2. The windows of an anchor lie in one context, the bytes from its first window to the end of its last. Equal
   contexts are counted: what stands twice is repeated as a whole.
3. The different contexts of a gram are sorted from the anchor onward, and backward from it, by a mergesort whose
   comparisons find the common extension by binary search over prefix polynomial hashes. Two contexts share a window
   when they agree far enough on both sides, which neighbours in the two orders tell for all windows at once.
   Common extensions of neighbours are verified byte by byte, so hash collisions can't remove a byte.
4. A gram with very many contexts is not gathered: its windows are compared by digest, a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import Block, blocks, slots, texts_of
from ferrycraft.session import new_path

SPAN = 400
#: Bytes of a gram; a window holds SPAN - GRAM + 1 of them.
GRAM = 64
#: Bytes hashed at a time, small enough for a core's cache.
HASH_BYTES = 512 << 10
#: Contexts sorted at a time, and the most that one gram may have to be sorted.
SORTED, HOT = 4096, 4096

BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bits of a position in the value that anchors are chosen by; the bits above are the gram's hash.
PLACE = np.uint64(28)
#: An anchor's context in one number: first window, bytes from it to the anchor, and further windows, 16 bits each.
FIELD = 16


class PrefixHashes:
    """Polynomial hashes modulo 2 ** 64 of every stretch of a buffer."""

    _powers = _unpowers = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        n, kind = len(data) + 1, type(self)
        if len(kind._powers) < n:
            kind._powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, BASE)]))
            kind._unpowers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, UNBASE)]))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * kind._powers[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self._unpowers[start]

    def grams(self, length: int) -> np.ndarray:
        """Mixed hashes of all stretches of one length."""
        count = len(self.sums) - length
        value = (self.sums[length:] - self.sums[:count]) * self._unpowers[:count]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values: running minima from both ends of blocks of that width."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    onward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], onward[width - 1:width - 1 + count])


def anchors(block: Block, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, gram hash, anchor, first window, last window) of a block; places count from the text's start."""
    bounds = block.bounds
    empty = np.zeros(0, np.int64)
    if len(block.data) < span:
        return (empty,) * 5
    hashes = PrefixHashes(block.data).grams(gram)
    if len(hashes) >> int(PLACE):
        raise ValueError("a text of over 256 MB needs more bits for positions")
    keyed = (hashes >> PLACE << PLACE) | np.arange(len(hashes), dtype=np.uint64)
    owner = (_least(keyed, span - gram + 1) & np.uint64((1 << int(PLACE)) - 1)).astype(np.int64)
    change = np.zeros(len(owner) + 1, np.int8)  # windows lie within a text
    long = np.diff(bounds) >= span
    change[bounds[:-1][long]] += 1
    change[bounds[1:][long] - span + 1] -= 1
    starts = np.flatnonzero(np.cumsum(change[:-1]))
    if not len(starts):
        return (empty,) * 5
    owner = owner[starts]
    edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([edge[1:], [len(owner)]]) - 1
    at, low, high = owner[edge], starts[edge], starts[last]
    text = np.searchsorted(bounds, low, "right") - 1
    base = bounds[text]
    return text, hashes[at].view(np.int64), at - base, low - base, high - base


def _anchored(texts: DataFrame, span: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, HASH_BYTES):
            text, *rest = anchors(block, span, gram)
            ids = block.rows.column(0).take(pa.array(text))
            grams, at, low, high = rest
            place = low << 2 * FIELD | at - low << FIELD | high - low
            yield pa.RecordBatch.from_arrays([ids, pa.array(grams), pa.array(place)], names=["id", "gram", "place"])

    return texts.mapInArrow(run, "id binary, gram long, place long")


def _contexts(texts: DataFrame, span: int) -> DataFrame:
    """A row for each anchor of ``places``; of equal contexts in a batch only the first carries its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            out: dict[str, list] = {n: [] for n in ("gram", "context", "id", "low", "last", "off", "bytes")}
            for row in range(batch.num_rows):
                own, text = batch.column(0)[row].as_py(), batch.column(1)[row].as_py().encode()
                for place in batch.column(2)[row].as_py():
                    low, off = place["place"] >> 2 * FIELD, place["place"] >> FIELD & (1 << FIELD) - 1
                    last = place["place"] & (1 << FIELD) - 1
                    part = text[low:low + last + span]
                    name = blake2b(part, digest_size=16, salt=off.to_bytes(4, "little")).digest()
                    for column, value in zip(out, (place["gram"], name, own, low, last, off, None if name in seen else part)):
                        out[column].append(value)
                    seen.add(name)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("gram", pa.int64()), ("context", pa.binary()), ("id", pa.binary()), ("low", pa.int32()),
                        ("last", pa.int32()), ("off", pa.int32()), ("bytes", pa.binary())])
    return texts.mapInArrow(run, "gram long, context binary, id binary, low int, last int, off int, bytes binary")


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How far the stretches from ``a`` and from ``b`` agree, up to ``most``: binary search over their hashes."""
    low, high = np.zeros_like(most), most.copy()
    for _ in range(int(most.max(initial=0)).bit_length()):
        middle = (low + high + 1) >> 1
        same = hashes.of(a, middle) == hashes.of(b, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def suffix_sort(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``data[starts:ends]`` within groups, and what each shares with the one before it.

    All groups are merge-sorted together, bottom up: a suffix's place in the merged run is its place in its own run
    plus its rank in the sibling run, found by binary search. Groups stand next to each other in the input.
    """
    n = len(starts)
    hashes, order = PrefixHashes(data), np.arange(n)
    head = np.searchsorted(group, group, "left")
    size = np.searchsorted(group, group, "right") - head
    local, padded = np.arange(n) - head, np.concatenate([data, [0]])

    def below(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` comes before suffix ``b``; equal ones by ``ties``."""
        rest_a, rest_b = ends[a] - starts[a], ends[b] - starts[b]
        shared = common_extension(hashes, starts[a], starts[b], np.minimum(rest_a, rest_b))
        next_a = np.where(shared < rest_a, padded[np.minimum(starts[a] + shared, len(data))].astype(np.int16), -1)
        next_b = np.where(shared < rest_b, padded[np.minimum(starts[b] + shared, len(data))].astype(np.int16), -1)
        return np.where(next_a == next_b, ties, next_a < next_b)

    width = 1
    while width < size.max(initial=0):
        run = local // width
        low = np.minimum((run ^ 1) * width, size)
        high = np.minimum(low + width, size)
        first, left = low.copy(), run % 2 == 0
        while len(open_ := np.flatnonzero(low < high)):  # rank of every suffix in its sibling run
            middle = (low[open_] + high[open_]) >> 1
            other = order[head[open_] + middle]
            before = below(other, order[open_], ~left[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = head + (run // 2) * 2 * width + local % width + low - first
        merged = np.empty_like(order)
        merged[place] = order
        order, width = merged, 2 * width
    shared = np.zeros(n, np.int64)
    inner = np.flatnonzero(local > 0)
    a, b = order[inner - 1], order[inner]
    shared[inner] = common_extension(hashes, starts[a], starts[b], np.minimum(ends[a] - starts[a], ends[b] - starts[b]))
    return order, shared


def _verified(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, shared: np.ndarray) -> bool:
    """Whether neighbours agree on what they are said to share, and stand in order right behind it."""
    at = np.flatnonzero(shared)
    length = shared[at]
    if len(at):
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        if (data[np.repeat(starts[order[at - 1]], length) + step] != data[np.repeat(starts[order[at]], length) + step]).any():
            return False
    a, b = starts[order[at - 1]] + length, starts[order[at]] + length
    ended, going = a >= ends[order[at - 1]], b < ends[order[at]]
    inside = ~ended & going
    return bool((ended | going).all() and (data[a[inside]] < data[b[inside]]).all())


def _plain_sort(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without hashes, for the case of a collision."""
    parts = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    order = sorted(range(len(parts)), key=lambda i: (group[i], parts[i]))
    shared = np.zeros(len(parts), np.int64)
    for i in range(1, len(order)):
        if group[order[i]] == group[order[i - 1]]:
            a, b = (np.frombuffer(parts[order[i - j]], np.uint8) for j in (1, 0))
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared[i] = differ[0] if len(differ) else n
    return np.array(order), shared


def _sorted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order, shared = suffix_sort(data, starts, ends, group)
    return (order, shared) if _verified(data, starts, ends, order, shared) else _plain_sort(data, starts, ends, group)


def repeated_windows(parts: list[bytes], offs: np.ndarray, group: np.ndarray, span: int) -> list[list[tuple[int, int]]]:
    """For each context of anchored groups the first and last of its runs of windows that another one holds too."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    at = begins + offs
    onward, ahead = _sorted(data, at, np.minimum(ends, at + span), group)
    mirror = len(data) - 1 - np.arange(len(data))
    backward, behind = _sorted(data[mirror], len(data) - at, len(data) - begins, group)
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    windows = sizes - span + 1
    found = np.zeros((len(parts), int(windows.max())), bool)
    right, left = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for before in range(int((offs - windows + 1).min()), int(offs.max()) + 1):  # bytes of the window before its anchor
        own = np.flatnonzero((offs >= before) & (before > offs - windows))
        if len(own) < 2:
            continue
        right[onward] = np.cumsum(fresh | (ahead < span - before))
        left[backward] = np.cumsum(fresh | (behind < before))
        pair = right[own] * (len(parts) + 1) + left[own]
        order = np.argsort(pair, kind="stable")
        same = pair[order[1:]] == pair[order[:-1]]
        twice = own[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
        found[twice, offs[twice] - before] = True
    out: list[list[tuple[int, int]]] = [[] for _ in parts]
    for row in np.flatnonzero(found.any(axis=1)).tolist():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], found[row], [0]]).astype(np.int8)))
        out[row] = list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))
    return out


_VERDICT = "context binary, first int, last int"


def _by_sorting(contexts: DataFrame, span: int) -> DataFrame:
    """``(context, first, last)``: runs of windows shared by contexts of a gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, names, offs, parts = [], [], [], []

        def settled(count: int) -> pa.RecordBatch:
            """Windows of the first ``count`` contexts, which end with a gram."""
            own = np.array(grams[:count], np.int64)
            several = np.flatnonzero(np.concatenate([[False], own[1:] == own[:-1]]) | np.concatenate([own[1:] == own[:-1], [False]]))
            out: dict[str, list] = {n: [] for n in ("context", "first", "last")}
            if len(several):
                chosen = several.tolist()
                runs = repeated_windows([parts[i] for i in chosen], np.array([offs[i] for i in chosen]), own[several], span)
                for i, spans in zip(chosen, runs):
                    for first, last in spans:
                        for column, value in zip(out, (names[i], first, last)):
                            out[column].append(value)
            for column in (grams, names, offs, parts):
                del column[:count]
            return pa.RecordBatch.from_pydict(out, schema=schema)

        for batch in batches:
            for gram, name, off, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if grams and gram == grams[-1] and name == names[-1]:
                    continue
                if len(grams) >= SORTED and gram != grams[-1]:
                    yield settled(len(grams))
                for column, value in zip((grams, names, offs, parts), (gram, name, off, part)):
                    column.append(value)
        yield settled(len(grams))

    schema = pa.schema([("context", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])
    dealt = contexts.select("gram", "context", "off", "bytes").repartition(slots(contexts), "gram")
    return dealt.sortWithinPartitions("gram", "context").mapInArrow(run, _VERDICT)


def _by_digest(contexts: DataFrame, span: int) -> DataFrame:
    """The same for grams with any number of contexts: a row for each window, grouped by what it holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, name, off, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                count = len(part) - span + 1
                windows = [blake2b(part[s:s + span], digest_size=16, salt=(off - s).to_bytes(4, "little")).digest()
                           for s in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, gram)), pa.array([name] * count, pa.binary()),
                     pa.array(np.arange(count, dtype=np.int32)), pa.array(windows, pa.binary())],
                    names=["gram", "context", "first", "window"])

    windows = contexts.select("gram", "context", "off", "bytes").mapInArrow(
        run, "gram long, context binary, first int, window binary").distinct()
    twice = windows.groupBy("gram", "window").count().where("count > 1").select("gram", "window")
    return windows.join(twice, ["gram", "window"]).select("context", "first", F.col("first").alias("last"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """``(key, n_bytes, spans, kept)`` for every row: ``spans`` are the removed runs, ``kept`` the remaining bytes.

    A byte goes when a string of ``span`` bytes that covers it also starts anywhere else, in the same text or in
    another; places count UTF-8 bytes, and ``kept`` may part a character. Rows are known by the digest of their
    text, so keys may repeat or be NULL, and copies of a text are repeats of each other. NULL and empty texts have
    no bytes; texts shorter than ``span`` stay whole; an empty table gives no rows; further columns are ignored.
    A gram with over ``hot`` different contexts is resolved window by window, with the same result.
    """
    if span >> FIELD:
        raise ValueError("spans of 64 KB and more need wider fields for places")
    source = texts_of(docs, key, text=text)
    named = source.select(key, F.unhex(F.md5("text")).alias("id"), "text")
    long = named.where(F.octet_length("text") >= span).select("id", "text")
    placed = _table(_anchored(long, span, gram), "anchors")
    # As tables, both sides of a join are plain scans: AQE can then split what is dealt by a frequent gram or context.
    repeated = _table(placed.groupBy("gram").count().where("count > 1").select(F.col("gram").alias("twice")), "repeated")
    places = placed.join(repeated, F.col("gram") == F.col("twice")).groupBy("id").agg(
        F.collect_set(F.struct("gram", "place")).alias("places"))
    held = _table(_contexts(long.join(places, "id").select("id", "text", "places"), span), "contexts")

    counted = _table(held.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.max("last").alias("last")), "counted")
    whole = counted.where("n > 1").select("context", F.lit(0).alias("first"), "last")
    crowded = _table(counted.groupBy("gram").count().where(F.col("count") > hot).select("gram"), "crowded")
    bodies = held.where(F.col("bytes").isNotNull())
    if crowded.isEmpty():
        shared = _by_sorting(bodies, span)
    else:
        shared = _by_sorting(bodies.join(crowded, "gram", "left_anti"), span).union(
            _by_digest(bodies.join(crowded, "gram", "left_semi"), span))
    verdicts = _table(shared.union(whole), "verdicts")
    spans = held.select("context", "id", "low").join(verdicts, "context").groupBy("id").agg(
        F.collect_set(F.struct((F.col("low") + F.col("first")).alias("start"),
                               (F.col("low") + F.col("last") + span).alias("end"))).alias("found"))
    return _without(named.join(spans, "id", "left").select(key, "text", "found"), key)


def _table(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again; hashes and overlapping contexts want the denser codec."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _without(rows: DataFrame, key: str) -> DataFrame:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, merged = text.encode(), []
                for start, end in sorted((s["start"], s["end"]) for s in found or ()):
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(end, merged[-1]["end"])
                    else:
                        merged.append({"start": start, "end": end})
                edges = [0, *(e for s in merged for e in (s["start"], s["end"])), len(data)]
                sizes.append(len(data))
                spans.append(merged)
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=[key, "n_bytes", "spans", "kept"])

    return rows.mapInArrow(run, rows.select(
        key, F.lit(0).cast("long").alias("n_bytes"),
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))).alias("spans"), F.lit(b"").alias("kept")).schema)
