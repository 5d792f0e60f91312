"""Benchmark passages in training texts, found by an FM-index of every training shard.

A shard is a block of texts in a task. Its words are coded by the phrases' vocabulary; a word that no phrase has ends
a run, and runs shorter than the shortest phrase can hold none, so they are left out without loss. Over the runs stand
a suffix array, its Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions. All phrases are
searched backward at once; occurrences are located by walking to the next sample and merged to spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, texts_of, with_columns

#: Bytes of text indexed at a time.
SHARD_BYTES = 8 << 20
#: Every so many positions of the indexed runs keep their place in the suffix order.
SAMPLE = 8
#: Words of windows in one broadcast; a larger benchmark takes several.
BLOCK_WORDS = 1 << 22
#: Lower case for A-Z; ASCII but letters and digits parts words.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass
class Phrases:
    """Distinct windows as rows of word codes (1 …, 0 behind short ones), and the items that hold each."""

    codes: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    owner_ends: np.ndarray
    items: list[str]


def phrase_blocks(benchmark: DataFrame, item: str, width: int, text: str = "text",
                  most: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark's windows, at most about ``most`` words at a time."""
    def made() -> Phrases:
        rows = np.zeros((len(seen), width), np.int64)
        for row, window in enumerate(seen):
            rows[row, :len(window)] = window
        ends = np.concatenate([[0], np.cumsum([len(o) for o in seen.values()])])
        return Phrases(codes, rows, np.array([len(w) for w in seen]), np.array([o for s in seen.values() for o in s]),
                       ends, items)

    codes, seen, items, size = {}, {}, [], 0
    source = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text))
    for name, passage in source.toLocalIterator():
        words = [codes.setdefault(w, len(codes) + 1) for w in words_of((passage or "").encode())]
        if not words:
            continue
        items.append(name)
        for at in range(max(1, len(words) - width + 1)):
            seen.setdefault(tuple(words[at:at + width]), {})[len(items) - 1] = None
            size += width
        if size >= most:
            yield made()
            codes, seen, items, size = {}, {}, [], 0
    if seen:
        yield made()


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes of runs parted by zeros, each zero a symbol of its own: prefix doubling up to the longest run."""
    n, parts = len(text), text == 0
    rank = np.where(parts, np.cumsum(parts) - 1, text + np.count_nonzero(parts))
    order, reach = np.argsort(rank, kind="stable"), 1
    while True:
        ahead = np.concatenate([rank[reach:], np.zeros(min(reach, n), np.int64)])[:n]
        pair = rank * (int(rank.max()) + 1) + ahead
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])])
        reach *= 2
        if reach > longest or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Count and locate words of a text of runs, each ended by a zero."""

    def __init__(self, text: np.ndarray, longest: int, symbols: int) -> None:
        order = suffix_order(text, longest)
        self.last = text[order - 1]  # the text ends with a zero, which comes round to its first word
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.levels, level = [], self.last
        for bit in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            on = (level >> bit) & 1 == 1
            ones = np.concatenate([[0], np.cumsum(on)])
            self.levels.append((bit, ones, len(level) - int(ones[-1])))
            level = np.concatenate([level[~on], level[on]])
        kept = (order % SAMPLE == 0) | (self.last == 0)
        self.kept, self.samples = np.concatenate([[0], np.cumsum(kept)]), order[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol stands before ``at`` in the transform."""
        low = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            on = (symbol >> bit) & 1 == 1
            low = np.where(on, zeros + ones[low], low - ones[low])
            at = np.where(on, zeros + ones[at], at - ones[at])
        return at - low

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all windows: those that occur, with their ranges of the suffix order."""
        alive, at = np.arange(len(windows)), lengths - 1
        symbol = windows[alive, at]
        first, last = self.below[symbol], self.below[symbol + 1]
        done: list[tuple[np.ndarray, ...]] = []
        while True:
            on = first < last
            ended = on & (at == 0)
            done.append((alive[ended], first[ended], last[ended]))
            on &= at > 0
            alive, at, first, last = alive[on], at[on] - 1, first[on], last[on]
            if not len(alive):
                return tuple(map(np.concatenate, zip(*done)))
            symbol = windows[alive, at]
            base = self.below[symbol]
            first, last = base + self.rank(symbol, first), base + self.rank(symbol, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of rows of the suffix order."""
        out, pending, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(pending):
            found = self.kept[rows + 1] > self.kept[rows]
            out[pending[found]] = self.samples[self.kept[rows[found]]] + steps
            pending, rows = pending[~found], rows[~found]
            symbol = self.last[rows]
            rows = self.below[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


def occurrences(coded: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every occurrence in a shard's codes, where 0 is any word or end that no phrase has."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], coded != 0, [0]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= phrases.lengths.min()
    starts, sizes = starts[long], (ends - starts)[long] + 1  # with the zero that ends it
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    origin = np.arange(sizes.sum()) + np.repeat(starts - before, sizes)
    text = np.concatenate([coded, [0]])[origin]
    index = FMIndex(text, int(sizes.max()), len(phrases.codes))
    found, first, last = index.search(phrases.windows, phrases.lengths)
    counts = last - first
    rows = np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    return origin[index.locate(rows)], np.repeat(found, counts)


def find_passages(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", width: int = 10,
                  text: str = "text", block_words: int = BLOCK_WORDS, keep_text: bool = False) -> DataFrame:
    """``(key, n_words, n_hit, items, spans)`` for every row of ``docs``.

    A window is ``width`` consecutive words of an item, or a shorter item's whole words; a word inside any
    occurrence is hit. ``items`` are the ids, as sorted strings, of items with occurring windows; ``spans`` are the
    merged runs of hit words as ``start`` and ``end`` in code points of the text. Occurrences never cross documents.
    The benchmark reaches the tasks in broadcasts of at most about ``block_words`` words, searched one after the
    other. NULL and wordless texts have no words and no hits, wordless items no windows, a NULL item id counts as the
    empty string; items with equal ids count once; repeated rows and NULL keys are kept; an empty benchmark hits
    nothing; further columns are ignored. With ``keep_text`` the text, NULL as empty, comes second.
    """
    kept_columns = [key, "text"] if keep_text else [key]
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(p) for p in phrase_blocks(benchmark, item, width, text, block_words)]
    schema = texts_of(docs, key, text=text).select(
        *kept_columns, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.lit([""]).alias("items"), F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))).alias("spans")
    ).schema
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, SHARD_BYTES):
            texts, codings, sizes = block.texts(), [[] for _ in shared], []
            for one in texts:
                words = words_of(one)
                sizes.append(len(words))
                for coding, phrases in zip(codings, shared):
                    coding.append(np.fromiter(map(phrases.value.codes.get, words, repeat(0)), np.int64, len(words)))
                    coding.append(np.zeros(1, np.int64))
            sizes = np.array(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes + 1)])
            change, holders = np.zeros(starts[-1] + 1, np.int64), [set() for _ in texts]
            for coding, phrases in zip(codings, shared):
                own = phrases.value
                at, window = occurrences(np.concatenate(coding), own)
                np.add.at(change, at, 1)
                np.add.at(change, at + own.lengths[window], -1)
                in_text = np.searchsorted(starts, at, "right") - 1
                for pair in np.unique(in_text * len(own.windows) + window).tolist():
                    number, one = divmod(pair, len(own.windows))
                    holders[number].update(
                        own.items[o] for o in own.owners[own.owner_ends[one]:own.owner_ends[one + 1]])
            hit = np.cumsum(change)[:-1] > 0
            n_hit = np.add.reduceat(hit, starts[:-1], dtype=np.int64)
            spans = [spans_of(texts[i], hit[starts[i]:starts[i + 1] - 1]) if n_hit[i] else [] for i in range(len(texts))]
            yield with_columns(block, kept_columns, n_words=sizes.astype(np.int64), n_hit=n_hit,
                               items=pa.array([sorted(h) for h in holders], pa.list_(pa.string())),
                               spans=pa.array(spans, span))

    return texts_of(docs, key, text=text).mapInArrow(run, schema)


def spans_of(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as code points of the text."""
    places = [m.span() for m in WORD.finditer(text.decode())]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]
