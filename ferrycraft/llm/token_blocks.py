"""Token ids in files of patched frame-of-reference blocks.

A file is a Parquet table of segments, so any store that Spark writes to will do and Spark's commit protocol keeps
a retried task from leaving half a file. A segment holds consecutive documents: their keys and lengths, and a
payload in the format below (all numbers little-endian).

    "PFB1"                      magic
    u32 values, u32 blocks      ids in the payload, blocks of BLOCK ids (the last one padded with its minimum)
    u32 starts[blocks + 1]      place of every block behind this table, so that a block is read alone
    blocks:
        u32 minimum, u8 width, u8 0, u16 exceptions
        u64 words[BLOCK * width / 64]     id - minimum, its lower ``width`` bits
        u8 places[exceptions], zeros up to a multiple of 4
        u32 highs[exceptions]             the bits above ``width``
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, slots, texts_of

MAGIC = b"PFB1"
BLOCK = 256
#: The width of a block holds this share of its values; the others are exceptions.
SHARE = 0.9
#: Ids of a segment, but for a longer document, which is a segment of its own.
SEGMENT = 1 << 18
#: Chunks joined to a text, and texts tokenized in a call.
JOINED, CALL = 500, 50
#: Characters of chunks that a worker's table holds before it starts anew; results don't depend on it.
TABLE_CHARS = 16 << 20


class Encoder:
    """A byte-level tokenizer in one worker, with a table of the ids of chunks it has met.

    A byte-level model parts a text at every space between two characters that are no white space, so a text of
    such spaces is its first word and then chunks of a space and a word. Chunks that the table lacks are tokenized
    joined to texts: only the first token of a chunk begins with its space, so they part again.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this worker one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        plan = json.loads(self.model.to_str())
        before = plan["pre_tokenizer"] or {}
        self.splits = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                       and not before.get("add_prefix_space") and not plan["normalizer"]
                       and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                   for t in plan["added_tokens"]))
        vocabulary = self.model.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self._clear()

    def _clear(self) -> None:
        self.table: dict[str, int] = {}
        self.flat, self.sizes, self.held = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for low in range(0, len(texts), CALL)
                for e in self.model.encode_batch_fast(texts[low:low + CALL], add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Take words into the table: -1 for those that begin or end with white space or are empty."""
        plain = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()]
        ids = self._direct(["".join(" " + w for w in plain[low:low + JOINED]) for low in range(0, len(plain), JOINED)])
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        firsts = np.flatnonzero(self.opens[ids])
        if len(firsts) != len(plain):
            each = self._direct([" " + w for w in plain])
            ids, firsts = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
        self.table.update(dict.fromkeys(words, -1))
        self.table.update(zip(plain, range(len(self.sizes), len(self.sizes) + len(plain))))
        self.sizes = np.concatenate([self.sizes, np.diff(firsts, append=len(ids))])
        self.flat = np.concatenate([self.flat, ids])
        self.held += sum(map(len, words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of every text."""
        if not self.splits:
            return self._direct(texts)
        split = [t.split(" ") for t in texts]
        if self.held > TABLE_CHARS:
            self._clear()
        fresh = set(chain.from_iterable(s[1:] for s in split)).difference(self.table)
        if fresh:
            self._learn(list(fresh))
        starts, find = np.cumsum(self.sizes) - self.sizes, self.table.__getitem__
        found = []
        for first, words in zip(self._direct([s[0] for s in split]), split):
            at = np.fromiter(map(find, words[1:]), np.int64, len(words) - 1)
            if words[0][-1:].isspace() or not words[0] or len(at) and at.min() < 0:
                found.append(None)  # runs of white space: the whole text is tokenized below
                continue
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            places = np.repeat(starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            found.append(np.concatenate([first, self.flat[places]]))
        rest = iter(self._direct([t for t, f in zip(texts, found) if f is None]))
        return [next(rest) if f is None else f for f in found]


@functools.lru_cache(4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(33)
def _layout(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For values of a block at ``width`` bits: word, shift in it, and the first value that begins in each word."""
    at = np.arange(BLOCK, dtype=np.uint64) * np.uint64(width)
    word = (at >> np.uint64(6)).astype(np.int64)
    return word, at & np.uint64(63), np.searchsorted(word, np.arange(BLOCK * width // 64))


def _pack(low: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2 ** width as rows of words."""
    word, shift, firsts = _layout(width)
    out = np.bitwise_or.reduceat(low << shift, firsts, axis=1)
    over = np.flatnonzero(shift + np.uint64(width) > 64)
    out[:, word[over] + 1] |= low[:, over] >> (np.uint64(64) - shift[over])
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    word, shift, _ = _layout(width)
    low = words[:, word] >> shift
    over = np.flatnonzero(shift + np.uint64(width) > 64)
    low[:, over] |= words[:, word[over] + 1] << (np.uint64(64) - shift[over])
    return low & np.uint64((1 << width) - 1)


def pack(ids: np.ndarray) -> bytes:
    """The payload of unsigned 32-bit ids."""
    count = -(-len(ids) // BLOCK)
    rows = np.zeros(count * BLOCK, np.uint64)
    rows[:len(ids)] = ids
    if count:
        rows[len(ids):] = rows[(count - 1) * BLOCK:len(ids)].min()
    rows = rows.reshape(count, BLOCK)
    least = rows.min(axis=1) if count else np.zeros(0, np.uint64)
    rows -= least[:, None]
    # A whole number below 2 ** 32 is exact as a double, so frexp gives its bit length.
    lengths = np.frexp(rows.astype(np.float64))[1].astype(np.uint8)
    widths = np.partition(lengths, int(SHARE * (BLOCK - 1)), axis=1)[:, int(SHARE * (BLOCK - 1))].astype(np.uint64)
    high = rows >> widths[:, None]
    counts = np.count_nonzero(high, axis=1)
    packed = [b""] * count
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        words = _pack(rows[at] & np.uint64((1 << width) - 1), width)
        for i, row in zip(at.tolist(), words):
            packed[i] = row.tobytes()
    where, place = np.nonzero(high)
    highs, places = high[where, place].astype("<u4"), place.astype(np.uint8)
    ends = np.concatenate([[0], np.cumsum(counts)])
    heads = np.zeros(count, [("minimum", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
    heads["minimum"], heads["width"], heads["exceptions"] = least, widths, counts
    parts = []
    for i in range(count):
        own = places[ends[i]:ends[i + 1]].tobytes()
        parts.append(heads[i].tobytes() + packed[i] + own + bytes(-len(own) % 4) + highs[ends[i]:ends[i + 1]].tobytes())
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("<u4")
    return MAGIC + np.array([len(ids), count], "<u4").tobytes() + starts.tobytes() + b"".join(parts)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload; raises ValueError when it isn't one."""
    if payload[:4] != MAGIC:
        raise ValueError("not a payload of token blocks")
    total, count = np.frombuffer(payload, "<u4", 2, 4).tolist()
    data = payload[12 + 4 * (count + 1):]
    starts = np.frombuffer(payload, "<u4", count + 1, 12).tolist()
    if len(data) != starts[-1]:
        raise ValueError("payload of token blocks is cut short")
    out, heads = np.zeros((count, BLOCK), np.uint64), []
    by_width: dict[int, list[int]] = {}
    for i, at in enumerate(starts[:-1]):
        least, head = int.from_bytes(data[at:at + 4], "little"), data[at + 4]
        heads.append((least, head, int.from_bytes(data[at + 6:at + 8], "little")))
        by_width.setdefault(head, []).append(i)
    for width, at in by_width.items():
        if width:
            size = BLOCK * width // 8
            words = np.frombuffer(b"".join(data[starts[i] + 8:starts[i] + 8 + size] for i in at), "<u8")
            out[at] = _unpack(words.reshape(len(at), -1), width)
    for i, (least, width, exceptions) in enumerate(heads):
        if exceptions:
            at = starts[i] + 8 + BLOCK * width // 8
            places = np.frombuffer(data, np.uint8, exceptions, at)
            highs = np.frombuffer(data, "<u4", exceptions, at + exceptions + -exceptions % 4)
            out[i, places] |= highs.astype(np.uint64) << np.uint64(width)
    out += np.array([h[0] for h in heads], np.uint64).reshape(count, 1)
    return out.ravel()[:total].astype(np.uint32)


def block(payload: bytes, number: int) -> np.ndarray:
    """The ids of one block, found by the table of block starts."""
    total, count = np.frombuffer(payload, "<u4", 2, 4).tolist()
    first, last = np.frombuffer(payload, "<u4", 2, 12 + 4 * number).tolist()
    base = 12 + 4 * (count + 1)
    own = payload[base + first:base + last]
    values = min(BLOCK, total - number * BLOCK)
    return unpack(MAGIC + np.array([values, 1, 0, len(own)], "<u4").tobytes() + own)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id",
                 text: str = "text") -> None:
    """Tokenize every text, append ``end_id`` and write the ids in ascending key order to ``path``.

    Documents are dealt to range partitions of the key, so the order needs no single task; a partition is a file and
    holds its number, ``part``;
    ``first`` counts the ids of the file before a segment. NULL and empty texts give the end id alone; rows with equal keys are ordered by the hash of the text;
    NULL keys come first; an empty table gives a table without segments; further columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, lengths, held, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_pydict({
                "part": [part], "first": [first], "keys": [pa.concat_arrays(keys).to_pylist()], "lengths": [lengths],
                "payload": [pack(ids)]}, schema=schema)

        for rows in blocks(batches):
            for row, ids in enumerate(encoder.encode([t.decode() for t in rows.texts()])):
                keys.append(rows.rows.column(0).slice(row, 1))
                held.append(np.append(ids, np.uint32(end_id)))
                lengths.append(len(held[-1]))
                size += len(held[-1])
                if size >= SEGMENT:
                    yield segment()
                    first += size
                    keys, lengths, held, size = [], [], [], 0
        if held:
            yield segment()

    source = texts_of(docs, key, text=text)
    kind = source.schema[key].dataType.simpleString()
    layout = f"part int, first long, keys array<{kind}>, lengths array<int>, payload binary"
    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("keys", pa.list_(_arrow(source, key))),
                        ("lengths", pa.list_(pa.int32())), ("payload", pa.binary())])
    # The hash keeps texts out of the sample of range keys, and parts rows that repeat a key.
    by = [F.col(key), F.xxhash64("text")]
    ordered = source.repartitionByRange(slots(docs), *by).sortWithinPartitions(*by)
    # Packed ids hardly shrink further.
    ordered.mapInArrow(run, layout).write.option("compression", "none").parquet(path)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    return df.select(name).limit(0).toArrow().schema.field(0).type


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids)`` of every document in the files: ``start`` counts the ids before it.

    ``ids`` are little-endian unsigned 32-bit integers in a binary value.
    """
    files = spark.read.parquet(path)
    kind = files.schema["keys"].dataType.elementType.simpleString()
    own = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    # A row for each file, as many as the writer had partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("part").agg(F.sum(own).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, keys, lengths, payload = (batch.column(i).slice(row, 1) for i in range(5))
                sizes, ids = lengths.flatten().to_numpy(), unpack(payload[0].as_py())
                ends = np.cumsum(sizes)
                firsts = ends - sizes
                offset = first.to_numpy()[0]
                data = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.to_numpy(), len(sizes))), keys.flatten(), pa.array(firsts + offset),
                     pa.array(sizes.astype(np.int64)),
                     pa.array([data[4 * a:4 * b] for a, b in zip(firsts.tolist(), ends.tolist())], pa.binary())],
                    names=["part", key, "first", "n_tokens", "ids"])

    docs = files.select("part", "first", "keys", "lengths", "payload").mapInArrow(
        run, f"part int, `{key}` {kind}, first long, n_tokens long, ids binary")
    return docs.join(F.broadcast(bases), "part").select(
        key, (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")
