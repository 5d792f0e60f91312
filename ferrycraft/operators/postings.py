"""Full text: postings with positions in delta-coded blocks, phrase search and ranked search.

A block holds a bounded part of a term's postings in document order, with the first and last document in front, so a term
in a third of all documents is many rows in many files, and blocks that no document of a rarer term can be in are
skipped before they are decoded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .hash_tree import LISTED, merged

#: Documents and positions a block holds at most, about.
BLOCK_DOCS, BLOCK_POSITIONS = 128, 4096
#: Words packed at a time, about.
HELD_WORDS = 1 << 21
#: Saturation and length normalisation of the BM25 rank (Robertson and Zaragoza, 2009).
K1, B = 1.2, 0.75

_SCHEMA = "term string, first bigint, last bigint, docs int, postings binary"


def words_of(text: Column) -> Column:
    """Terms in order, lower case, without empty ones."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def _packed(values: np.ndarray) -> bytes:
    """Non-negative numbers as groups of seven bits, least first, the high bit on all but a number's last byte."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for group in range(1, 10):
        size += values >> np.uint64(7 * group) > 0
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    out = (np.repeat(values, size) >> (at * 7).astype(np.uint64)) & np.uint64(127)
    out[at < np.repeat(size, size) - 1] |= np.uint64(128)
    return out.astype(np.uint8).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else np.zeros(0, np.int64)
    at = np.arange(len(raw)) - np.repeat(starts, last - starts + 1)
    parts = (raw & 127).astype(np.uint64) << (at * 7).astype(np.uint64)
    return np.add.reduceat(parts, starts) if len(starts) else np.zeros(0, np.uint64)


def pack_block(docs: np.ndarray, counts: np.ndarray, positions: np.ndarray) -> bytes:
    """Gaps between documents, numbers of positions, gaps between the positions of each document."""
    heads = np.cumsum(counts) - counts
    gaps = np.diff(positions, prepend=0)
    gaps[heads] = positions[heads]
    return _packed(np.concatenate([[len(docs)], np.diff(docs, prepend=docs[0]), counts, gaps]).astype(np.int64))


def unpack_block(first: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = _unpacked(data).astype(np.int64)
    n = int(values[0])
    docs, counts, gaps = first + np.cumsum(values[1:n + 1]), values[n + 1:2 * n + 1], values[2 * n + 1:]
    total = np.cumsum(gaps)
    heads = np.cumsum(counts) - counts
    return docs, counts, total - np.repeat(total[heads] - gaps[heads], counts)


def _packed_lists(docs: np.ndarray, counts: np.ndarray, positions: np.ndarray, starts: np.ndarray) -> pa.Array:
    """``pack_block`` of each run of postings that begins at ``starts``."""
    heads, n = np.cumsum(counts) - counts, np.diff(starts, append=len(docs))
    first = heads[starts]
    base = 2 * starts + first + np.arange(len(starts))  # a block is its number of documents, two lists as long, positions
    values = np.zeros(len(starts) + 2 * len(docs) + len(positions), np.int64)
    values[base] = n
    of, nth = np.repeat(np.arange(len(starts)), n), np.arange(len(docs)) - np.repeat(starts, n)
    gaps = np.diff(docs, prepend=docs[:1])
    gaps[starts] = 0
    values[base[of] + 1 + nth] = gaps
    values[base[of] + 1 + n[of] + nth] = counts
    steps = np.diff(positions, prepend=0)
    steps[heads] = positions[heads]
    values[np.repeat(base[of] + 1 + 2 * n[of] - first[of], counts) + np.arange(len(positions))] = steps
    size = np.ones(len(values), np.int64)
    for group in range(1, 10):
        size += values >> (7 * group) > 0
    ends = np.concatenate([[0], np.cumsum(size)])
    offsets = ends[np.append(base, len(values))].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(_packed(values))])


def build_postings(df: DataFrame, key: str, text: str, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Blocks of postings, and ``doc, length`` of every document with a term, from an integer key and a text column.

    Texts, not words, are shuffled: a task has a range of documents in order and packs the blocks of some millions of
    words at a time, which are then clustered by term. A document's rows are read together: a key of several rows counts
    positions on from row to row in no stated order, so phrases don't span rows reliably; give each row its own key. NULL
    keys and texts have no postings.
    """
    texts = df.select(F.col(f"`{key}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text")).where(
        "doc IS NOT NULL AND text IS NOT NULL")
    worded = lambda rows: rows.select("doc", words_of(F.col("text")).alias("words")).where("size(words) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lengths_of(docs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            """A document's length as a row without a term."""
            own, heads = np.unique(docs, return_index=True)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(own), pa.string()), pa.array(own), pa.array(np.add.reduceat(counts, heads)),
                 pa.nulls(len(own), pa.int32()), pa.nulls(len(own), pa.binary())], names=["term", "first", "last", "docs", "postings"])

        def made(docs: np.ndarray, counts: np.ndarray, words: pa.Array) -> pa.RecordBatch:
            coded = words.dictionary_encode()
            doc = np.repeat(docs, counts)
            at = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
            code = coded.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            code, doc, at = code[order], doc[order], at[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
            heads = np.flatnonzero(new)
            code, doc, held = code[heads], doc[heads], np.diff(heads, append=len(at))
            left = np.searchsorted(code, code, "left")
            nth, before = (np.arange(len(code)) - left) // BLOCK_DOCS, (heads - heads[left]) // BLOCK_POSITIONS
            cut = np.ones(len(code), bool)
            cut[1:] = (code[1:] != code[:-1]) | (nth[1:] != nth[:-1]) | (before[1:] != before[:-1])
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(code))
            return pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(code[starts])), pa.array(doc[starts]), pa.array(doc[ends - 1]),
                 pa.array((ends - starts).astype(np.int32)), _packed_lists(doc, held, at, starts)],
                names=["term", "first", "last", "docs", "postings"])

        def joined(rows: list) -> tuple[np.ndarray, np.ndarray, pa.Array]:
            return np.concatenate([x for x, _, _ in rows]), np.concatenate([x for _, x, _ in rows]), pa.concat_arrays(
                [x for _, _, x in rows])

        rows, size, enough = [], 0, HELD_WORDS
        for batch in batches:
            if not len(batch):
                continue
            words = batch.column(1)
            rows.append((batch.column(0).to_numpy(), words.value_lengths().to_numpy().astype(np.int64), words.flatten()))
            size += len(rows[-1][2])
            if size >= enough:
                docs, counts, words = joined(rows)
                cut = int(np.searchsorted(docs, docs[-1], "left"))  # the last document may go on in the next batch
                at = int(counts[:cut].sum())
                if cut:
                    yield lengths_of(docs[:cut], counts[:cut])
                    yield made(docs[:cut], counts[:cut], words[:at])
                rows, size = [(docs[cut:], counts[cut:], words[at:])], size - at
                enough = HELD_WORDS + size
        if rows:
            rest = joined(rows)
            yield lengths_of(*rest[:2])
            yield made(*rest)

    packed = stage(worded(texts.repartitionByRange("doc").sortWithinPartitions("doc")).mapInArrow(run, _SCHEMA), "blocks")
    order = ["term", "first"]
    blocks = packed.where("term IS NOT NULL")
    lengths = packed.where("term IS NULL").select(F.col("first").alias("doc"), F.col("last").alias("length"))
    ranged = blocks.repartitionByRange(partitions, *order) if partitions else blocks.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order), lengths


def write_postings(df: DataFrame, key: str, text: str, path: str, partitions: int | None = None,
                   mode: str = "errorifexists") -> None:
    """``path/blocks``, clustered by term and document, and ``path/lengths``."""
    blocks, lengths = build_postings(df, key, text, partitions)
    blocks.write.mode(mode).parquet(f"{path}/blocks")
    lengths.write.mode(mode).parquet(f"{path}/lengths")


def read_postings(blocks: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``term, doc, positions`` of the terms."""
    wanted = blocks.where(F.col("term").isin(*set(terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = [unpack_block(first, data) for first, data in zip(*(batch.column(i).to_pylist() for i in (1, 4)))]
            docs, counts, positions = (np.concatenate(x) for x in zip(*found))
            of = np.repeat(np.arange(len(found)), [len(x) for x, _, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(docs), pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(positions))],
                names=["term", "doc", "positions"])

    return wanted.mapInArrow(run, "term string, doc bigint, positions array<bigint>")


def candidate_blocks(blocks: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Blocks of the terms whose range of documents meets a block of the rarest term.

    The rarest term's blocks are told to the scan as a bounded list of intervals, coarser where they are many.
    """
    names = list(dict.fromkeys(terms))
    wanted = blocks.where(F.col("term").isin(*names))
    sizes = {r["term"]: r["n"] for r in wanted.groupBy("term").agg(F.sum("docs").alias("n")).collect()}
    if len(sizes) < len(names):
        return wanted.limit(0)  # a term that no document has
    rarest = min(names, key=lambda t: (sizes[t], t))
    lead = wanted.where(F.col("term") == rarest)
    low, high = lead.agg(F.min("first"), F.max("last")).first()
    coarse = -(-(high - low + 1) // LISTED)
    parts = lead.select(F.explode(F.expr(f"sequence((first - {low}) div {coarse}, (last - {low}) div {coarse})")).alias("p"))
    ranges = [(F.col("first") < low + b * coarse) & (F.col("last") >= low + a * coarse)
              for a, b in merged(sorted(r[0] for r in parts.distinct().collect()))]
    return wanted.where((F.col("term") == rarest) | reduce(lambda x, y: x | y, ranges))


def search_phrase(blocks: DataFrame, phrase: str) -> DataFrame:
    """``doc, hits``: documents that hold the words of the phrase one behind the other, and how often."""
    terms = [r[0] for r in blocks.sparkSession.range(1).select(F.explode(words_of(F.lit(phrase)))).collect()]
    if not terms:
        return blocks.sparkSession.createDataFrame([], "doc bigint, hits bigint")
    found = read_postings(candidate_blocks(blocks, terms), terms)
    # a document's places of all terms meet in one row, as starts that they would belong to; common ones are hits
    names = list(dict.fromkeys(terms))
    places = found.groupBy("doc").agg(*[F.flatten(F.collect_list(F.when(F.col("term") == t, F.col("positions")))).alias(
        f"p{i}") for i, t in enumerate(names)])
    starts = [F.expr(f"transform(p{names.index(t)}, p -> p - {i})") for i, t in enumerate(terms)]
    hits = F.size(reduce(F.array_intersect, starts)).cast("bigint")
    return places.select("doc", hits.alias("hits")).where("hits > 0")


def search_ranked(blocks: DataFrame, lengths: DataFrame, query: str, n: int = 10) -> DataFrame:
    """``doc, score`` of the n best documents for any of the query's words by BM25, ties by the smaller document.

    Scores are rounded to nine digits, so that equal ones are equal whatever the order of summing.
    """
    spark = blocks.sparkSession
    terms = sorted({r[0] for r in spark.range(1).select(F.explode(words_of(F.lit(query)))).collect()})
    if not terms:
        return spark.createDataFrame([], "doc bigint, score double")
    total, mean = lengths.agg(F.count(F.lit(1)), F.avg("length")).first()
    weights = {r["term"]: np.log(1 + (total - r["n"] + 0.5) / (r["n"] + 0.5)) for r in blocks.where(
        F.col("term").isin(*terms)).groupBy("term").agg(F.sum("docs").alias("n")).collect()}
    if not weights:
        return spark.createDataFrame([], "doc bigint, score double")
    weight = F.create_map(*[F.lit(x) for t, w in weights.items() for x in (t, float(w))])
    found = read_postings(blocks, terms).select("term", "doc", F.size("positions").alias("tf")).join(lengths, "doc")
    share = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(float(mean))))
    scored = found.groupBy("doc").agg(F.round(F.sum(weight[F.col("term")] * share), 9).alias("score"))
    return scored.orderBy(F.desc("score"), "doc").limit(n)
