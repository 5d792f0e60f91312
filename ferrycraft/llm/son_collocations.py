"""Phrase collocations by partitioning (Savasere, Omiecinski, Navathe: "An efficient algorithm for mining association
rules in large databases", 1995): shards are mined at a proportionally lower support, then their finds counted globally.

Texts are dealt to a few shards by hash. A phrase found ``support`` times overall is found ``support / shards`` times
(rounded up) in one shard at least, and so are its parts, so each shard is mined level by level at that local support;
copies of a text share a shard. Mining goes by hashes of phrases, whose collisions can only add phrases. What a level
found is handed on as bitmaps of bounded size, in which a false hit adds work but changes no result. The union of all
shards' finds is then counted over all texts, exactly and by the words themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import Block, blocks, texts_of
from ferrycraft.session import stage

SHARDS = 4
#: Bits of a bitmap, at most (16 MB), and bits for each phrase where that is less.
BITS, BITS_EACH = 1 << 27, 16
#: Hashes counted at a time, distinct phrases a task counts before it passes them on, and words with a known hash.
HASHES, COUNTED, KNOWN = 1 << 21, 1 << 18, 1 << 18

#: Marks the end of a piece; it is no part of any word.
END = b"."
FOLD = bytes(ord(END) if b in b".,;:!?\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words in order, with ``END`` between pieces and between texts; only A-Z are lower-cased."""
    return END.join(texts).translate(FOLD).replace(END, b" . ").split()


class _Hashes(dict):
    """Hashes of words, ``END`` is 0; begins anew when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = found = 0 if word == END else xxhash.xxh64_intdigest(word) | 1
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def phrase_hashes(words: np.ndarray, size: int, salt: int) -> np.ndarray:
    """The hash of the phrase of ``size`` words at each place, under a salt; ends of pieces are not looked at."""
    found = np.full(len(words) - size + 1, salt, np.uint64)
    for place in range(size):
        found = _mixed(found + words[place:place + len(found)])
    return found


class Bitmap:
    """Hashes that were found; answers yes for all of them and for few others."""

    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.bits = np.zeros(bits // 8, np.uint8)
        for bucket, chunk in chunks.items():
            part = self.bits[(bucket - 1) * 4096:bucket * 4096]
            part[:] = np.frombuffer(chunk, np.uint8)[:len(part)]
        self.mask = np.uint64(bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap(hashes: DataFrame, n: int) -> Bitmap:
    """A bitmap of the ``h`` column of ``n`` rows, built in tasks; at most ``BITS / 8`` bytes reach the driver."""
    bits = 1 << 15
    while bits < min(BITS, n * BITS_EACH):
        bits *= 2
    # positions count from 1: bucket b holds those after (b - 1) * 32768
    at = hashes.select((F.col("h").bitwiseAND(F.lit(bits - 1)) + 1).alias("at"))
    chunks = at.groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("chunk")).collect()
    return Bitmap(bits, {r["bucket"]: bytes(r["chunk"]) for r in chunks})


def _grouped(block: Block, *names: str) -> Iterator[tuple[tuple, list[bytes]]]:
    """The block's texts by the values of the named columns."""
    keys = zip(*(block.rows.column(block.rows.schema.get_field_index(n)).to_pylist() for n in names))
    found: dict[tuple, list[bytes]] = {}
    for key, text in zip(keys, block.texts()):
        found.setdefault(key, []).append(text)
    yield from found.items()


def _salt(lang: str, shard: int = -1) -> int:
    return xxhash.xxh64_intdigest(f"{shard}:{lang}")


def _counted(docs: DataFrame, phrases: Callable[[Block], Iterator[tuple[str, list]]]) -> DataFrame:
    """``(lang, phrase, n)`` of what ``phrases`` gives for a block; counts start in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = {}

        def made() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()).cast(pa.string()),
                     pa.array(own.values(), pa.int64())], names=["lang", "phrase", "n"])
            counts.clear()

        for block in blocks(batches):
            for lang, found in phrases(block):
                counts.setdefault(lang, Counter()).update(found)
            if sum(map(len, counts.values())) > COUNTED:
                yield from made()
        yield from made()

    found = docs.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _word_counts(docs: DataFrame) -> DataFrame:
    def phrases(block: Block) -> Iterator[tuple[str, list]]:
        for (lang,), texts in _grouped(block, "lang"):
            yield lang, [w for w in words_of(texts) if w != END]

    return _counted(docs, phrases)


def _places(words: np.ndarray, size: int, lang: str, shard: int, frequent: Bitmap, found: list[Bitmap]) -> np.ndarray:
    """Where phrases of ``size`` words start whose words, then whose parts in the shard, are marked frequent."""
    if len(words) < size:
        return np.zeros(0, int)
    single = (words != 0) & frequent.has(phrase_hashes(words, 1, _salt(lang)))
    open_at = single[:len(words) - size + 1].copy()
    for place in range(1, size):
        open_at &= single[place:place + len(open_at)]
    if size > 2:  # parts of all but one word; their own parts were asked for on their level
        part = found[size - 3].has(phrase_hashes(words, size - 1, _salt(lang, shard)))
        open_at &= part[:-1] & part[1:]
    return np.flatnonzero(open_at)


def _mined(docs: DataFrame, size: int, local: int, frequent, found: list) -> DataFrame:
    """``h`` of the phrases of ``size`` words that are locally frequent in a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _Hashes(), []
        levels = [f.value for f in found]

        def made() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["h", "n"])

        for block in blocks(batches):
            for (lang, shard), texts in _grouped(block, "lang", "shard"):
                words = known.of(words_of(texts))
                at = _places(words, size, lang, shard, frequent.value, levels)
                if len(at):
                    held.append(phrase_hashes(words, size, _salt(lang, shard))[at])
            if sum(map(len, held)) > HASHES:
                yield made()
        yield made()

    return docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(
        F.col("n") >= local).select("h")


def _candidate_counts(docs: DataFrame, longest: int, shards: int, frequent, found: list) -> DataFrame:
    """``(lang, phrase, n)``: all occurrences of every phrase that some shard found."""

    def phrases(block: Block) -> Iterator[tuple[str, list]]:
        levels = [f.value for f in found]
        for (lang,), texts in _grouped(block, "lang"):
            words = words_of(texts)
            hashes = _Hashes().of(words)
            for size in range(2, longest + 1):
                at = _places(hashes, size, lang, -1, frequent.value, []) if size == 2 else following
                if not len(at):
                    break
                asked = np.zeros(len(at), bool)
                for shard in range(shards):
                    asked |= levels[size - 2].has(phrase_hashes(hashes, size, _salt(lang, shard))[at])
                at = at[asked]
                yield lang, [b" ".join(words[i:i + size]) for i in at.tolist()]
                # a longer phrase is asked for only where both of its parts were
                following = at[:-1][np.diff(at) == 1]

    return _counted(docs, phrases)


def phrase_counts(docs: DataFrame, support: int = 10, longest: int = 3, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, n)`` of all words, and of all phrases of 2 to ``longest`` words found ``support`` times or more."""
    session = docs.sparkSession.sparkContext
    texts = texts_of(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text"), "lang")
    local = -(-support // shards)
    words = stage(_word_counts(texts), "words")

    often = stage(words.where(F.col("n") >= support).select("lang", "phrase"), "frequent_words")

    def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            own = known.of([w.encode() for w in batch.column(1).to_pylist()])
            salts = np.array([_salt(lang) for lang in batch.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(salts + own).view(np.int64))], names=["h"])

    frequent = session.broadcast(bitmap(often.mapInArrow(salted, "h long"), often.count()))
    dealt = texts.select("lang", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text")
    found = []
    for size in range(2, longest + 1):
        level = stage(_mined(dealt, size, local, frequent, found), "local_phrases")
        found.append(session.broadcast(bitmap(level, level.count())))
    phrases = _candidate_counts(texts, longest, shards, frequent, found).where(F.col("n") >= support)
    return words, stage(phrases, "phrases")


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, support: int = 10, longest: int = 3, most: int = 2000, inside: int = 50,
                 shards: int = SHARDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of each language.

    Only A-Z are lower-cased; pieces end at ``.,;:!?`` and line breaks, words at blanks and tabs. ``a`` counts a phrase
    of 2 to ``longest`` words, ``support`` at least; ``n`` counts all words of the language. ``l`` and ``r`` count the
    parts before and after the cut with the least ``floor(1000000 * a * a / (l * r))``, the first such cut, and
    that is the score. A phrase inside a longer one of ``inside`` percent of its count or more is dropped. Ranks go
    by score, then by ``a``, both descending, then by the phrase's bytes. A NULL language is ``und``; NULL, empty
    and wordless texts have no phrases; repeated rows count each; an empty table gives no rows; further columns are
    ignored. Counts over 10 ** 15 fail.
    """
    words, phrases = phrase_counts(docs, support, longest, shards)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    split = phrases.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words"))
    parts = words.where(F.col("n") >= support).union(phrases).select(
        F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("found"))
    cuts = split.select("lang", "phrase", "n", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
                        "words", "size").select("lang", "phrase", "n", "k", _part(1, F.col("k")).alias("head"),
                                                _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    scored = cuts.join(parts, (F.col("lang") == F.col("of")) & (F.col("head") == F.col("part"))).withColumn(
        "l", F.col("found")).drop("of", "part", "found").join(
        parts, (F.col("lang") == F.col("of")) & (F.col("tail") == F.col("part"))).withColumn("r", F.col("found"))
    score = F.expr("""(cast(1000000 AS decimal(7,0)) * cast(n AS decimal(15,0)) * cast(n AS decimal(15,0)))
                      div (cast(l AS decimal(15,0)) * cast(r AS decimal(15,0)))""")
    best = scored.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("n").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every shorter phrase that lies in a phrase, with the most that any of its holders is found
    held = split.where("size > 2").select("lang", "n", "size", "words", F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("own")).select("lang", "n", "words", "own", F.explode(
            F.sequence(F.lit(1), F.col("size") - F.col("own") + 1)).alias("at"))
    holders = held.select(F.col("lang").alias("of"), _part(F.col("at"), F.col("own")).alias("part"), "n").groupBy(
        "of", "part").agg(F.max("n").alias("most"))
    kept = best.join(holders, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left").where(
        F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a")))
    kept = stage(kept.select("lang", "phrase", "a", "cut"), "scored")
    numbered = kept.selectExpr("*", """row_number() OVER (PARTITION BY lang
        ORDER BY cut.score DESC, a DESC, phrase) AS rank""").where(F.col("rank") <= most)
    return numbered.join(totals.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").alias("score"))
