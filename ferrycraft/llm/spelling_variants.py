"""Spelling variants: words one edit apart, found through an index of variable-length grams.

Grams start with ``SHORTEST`` code points and are lengthened, up to ``LONGEST``, while they are frequent, so lists stay
short where the text is repetitive; only the frequent ones need a dictionary. A word has one gram for each start. An edit
affects the grams that it lies in (and one that stopped at the end of the word, if it appends there); all others are
grams of the edited word too. So two bounds hold for each word: of its rarest grams, the shortest run that no single edit
affects whole has a member that near words share, and near words lack no more of its grams than the largest number one
edit affects. Lists are merged for the first run only, between entries that agree in what lies on the unedited side of
the gram; the second bound is tested on signatures; what is left is verified code point by code point.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, slots, texts_of
from ferrycraft.session import stage

SHORTEST, LONGEST = 2, 4
#: Occurrences, over the distinct words, above which a gram is lengthened; more where the dictionary would pass FREQUENT.
OFTEN = 200
#: Bound on the broadcast dictionary: fewer than positions / threshold grams of one length can be over the threshold.
FREQUENT = 1 << 19
#: A list with more entries is merged by deletion variants instead, whose lists are bounded by the words' length.
CELL_LIMIT = 4096
#: Distinct words a task counts before it passes them on, entries of lists compared at a time, and pairs of them.
COUNTED, PAIRS = 1 << 18, 1 << 20
#: Words up to this length are verified as rows of one matrix.
WIDE = 32

RUN = regex.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")


def _damaged(run: bytes, h: int) -> bytes:
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1:]).encode()


def count_words(docs: DataFrame, key: str = "doc_id", damage: int = 31, least_length: int = 7,
                least_count: int = 2) -> DataFrame:
    """``(word, n)``: runs of Latin letters, of the given length and number at least, only A-Z lower-cased.

    Where ``damage`` divides the CRC-32 of ``key:run``, one code point of the run goes (``0``: none does). Counting
    starts in the tasks, document by document; a NULL key reads as the empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            names = [w.decode() for w in counts]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts.values(), pa.int64())],
                                              names=["word", "n"])

        counts: Counter[bytes] = Counter()
        for block in blocks(batches):
            keys = block.rows.column(block.rows.schema.get_field_index("name")).to_pylist()
            for name, text in zip(keys, block.texts()):
                own = Counter(RUN.findall(text.lower()))
                head = crc32(f"{name}:".encode())
                for word, n in own.items():
                    if damage and not (h := crc32(word, head)) % damage:
                        word = _damaged(word, h)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > COUNTED:
                    yield made()
                    counts.clear()
        yield made()

    source = texts_of(docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"), "text"), "name")
    found = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def gram_dictionary(words: DataFrame, often: int = OFTEN) -> tuple[DataFrame, int]:
    """``(gram, n)`` of the grams that are lengthened, and the number of occurrences above which they are."""
    starts = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    often = max(often, -(-starts * (LONGEST - SHORTEST) // FREQUENT))
    length = F.char_length("word")
    own = F.flatten(F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST - 1)), lambda size: F.transform(
        F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1))), lambda at: F.substr("word", at, size))))
    counted = words.where(length >= SHORTEST).select(F.explode(own).alias("gram")).groupBy("gram").agg(
        F.count("*").alias("n"))
    return counted.where(F.col("n") > often), often


def grams(word: str, frequent: dict[str, int]) -> list[tuple[int, str, int, int, bool]]:
    """``(rank, gram, start, end, open)`` for each start; open grams would go on if the word did.

    The rank is the gram's number in the dictionary, 0 for all it doesn't hold.
    """
    found, length = [], len(word)
    for start in range(max(1, length - SHORTEST + 1)):
        end = min(start + SHORTEST, length)
        while end < length and end - start < LONGEST and word[start:end] in frequent:
            end += 1
        gram = word[start:end]
        found.append((frequent.get(gram, 0), gram, start, end,
                      end == length and end - start < LONGEST and (gram in frequent or end - start < SHORTEST)))
    return found


def affected(start: int, end: int, open_end: bool) -> tuple[int, int]:
    """The edits that affect a gram, from and to: edit 2i + 1 changes code point i, edit 2i inserts one before it."""
    return 2 * start + 1, 2 * end + open_end


@lru_cache(1 << 16)
def _bit(gram: str) -> int:
    return 1 << (xxhash.xxh64_intdigest(gram) & 63)


def entries(word: str, frequent: dict[str, int]) -> tuple[list[int], int, int]:
    """The list keys of a word, its signature of 64 bits, and the most grams that one edit affects.

    Lists are made for the rarest grams until no edit affects all of them; each gram gives one for edits on its right,
    named by all up to its end, and one for edits on its left, named by all from its start. Words so short that an edit
    may affect all grams are in the lists of their deletion variants too.
    """
    own, keys, signature = sorted(grams(word, frequent)), [], 0
    change = [0] * (2 * len(word) + 2)
    first, last = 0, 2 * len(word) + 1
    for _, gram, start, end, open_end in own:
        low, high = affected(start, end, open_end)
        change[low] += 1
        change[high] -= 1
        signature |= _bit(gram)
        if first < last:
            keys.append("<" + word[:end])
            keys.append(">" + word[start:])
            first, last = max(first, low), min(last, high)
    if len(word) <= SHORTEST + LONGEST:  # one edit may affect all grams of the word, or of one a code point shorter
        keys += ["-" + w for w in [word, *(word[:i] + word[i + 1:] for i in range(len(word)))]]
    return [xxhash.xxh64_intdigest(k) for k in dict.fromkeys(keys)], signature, max(accumulate(change))


def _index(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``(cell, word, n, signature, most)``, a row for each list that a word is in."""
    held = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [entries(w, held.value) for w in batch.column(0).to_pylist()]
            if not made:
                continue
            at = np.repeat(np.arange(len(made)), [len(keys) for keys, _, _ in made])
            cells = np.fromiter((k for keys, _, _ in made for k in keys), np.uint64, len(at)).view(np.int64)
            signatures = np.array([s for _, s, _ in made], np.uint64).view(np.int64)[at]
            bounds = np.array([min(m, 64) for _, _, m in made], np.int8)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                 pa.array(signatures), pa.array(bounds)], names=["cell", "word", "n", "signature", "most"])

    return words.select("word", "n").mapInArrow(run, "cell long, word string, n long, signature long, most byte")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)):] == b[same + 1:]


def _verified(a: np.ndarray, b: np.ndarray, length: np.ndarray, codes: np.ndarray, words: list[str]) -> np.ndarray:
    """Which pairs of positions are one edit apart; the shorter word of a pair comes first."""
    true = np.zeros(len(a), bool)
    short = length[b] <= WIDE
    x, y = codes[a[short]], codes[b[short]]
    differ = x != y
    even = length[a[short]] == length[b[short]]
    same = differ.argmax(axis=1)
    shifted = x[:, :-1] != y[:, 1:]
    late = np.arange(WIDE)[None, :] >= same[:, None]
    true[short] = np.where(even, differ.sum(axis=1) == 1, differ.any(axis=1) & ~(shifted & late).any(axis=1))
    for at in np.flatnonzero(~short):
        true[at] = one_edit(words[a[at]], words[b[at]])
    return true


def near_pairs(cells: np.ndarray, words: list[str], signatures: np.ndarray,
               most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of one list that are one edit apart; rows come sorted by list, then by length.

    Rows are compared with the one ``step`` below them while any list has one of no more than a code point more, so memory
    follows the rows.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    # one column more than the widest word, so that a shifted row ends in padding
    codes = np.frombuffer("".join(w[:WIDE].ljust(WIDE + 1, "\0") for w in words).encode("utf-32-le"), np.uint32)
    codes = codes.reshape(len(words), WIDE + 1)
    runs = np.concatenate([[0], np.cumsum(cells[1:] != cells[:-1])]) << 40
    ends = np.searchsorted(runs + length, runs + length + 1, "right")
    left = np.flatnonzero(ends - np.arange(len(cells)) > 1)
    step = 1
    while len(left):
        for low in range(0, len(left), PAIRS):
            a = left[low:low + PAIRS]
            b = a + step
            kept = np.bitwise_count(signatures[a] & ~signatures[b]) <= most[a]
            a, b = a[kept], b[kept]
            kept = np.bitwise_count(signatures[b] & ~signatures[a]) <= most[b]
            a, b = a[kept], b[kept]
            true = _verified(a, b, length, codes, words)
            if true.any():
                yield a[true], b[true]
        step += 1
        left = left[left + step < ends[left]]


def _merged(keyed: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)`` of near words that share a list; lists are read as sorted runs."""
    names = ["a", "a_n", "b", "b_n"]

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cells = rows.column(0).to_numpy()
        alone = np.ones(len(cells), bool)
        same = cells[1:] == cells[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        rows = rows.filter(pa.array(~alone))
        if not len(rows):
            return
        words, n = rows.column(1).combine_chunks(), rows.column(2).to_numpy()
        for a, b in near_pairs(rows.column(0).to_numpy(), words.to_pylist(), rows.column(3).to_numpy().view(np.uint64),
                               rows.column(4).to_numpy()):
            yield pa.RecordBatch.from_arrays([words.take(pa.array(a)), pa.array(n[a]), words.take(pa.array(b)),
                                              pa.array(n[b])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if not len(rows):
                continue
            cells = rows.column(0).to_numpy()
            last = int(np.searchsorted(cells, cells[-1], "left"))  # the last list may go on in the next batch
            yield from pairs(rows.slice(0, last))
            rest = rows.slice(last)
        if rest is not None:
            yield from pairs(rest)

    spread = keyed.repartition(slots(keyed), "cell").sortWithinPartitions("cell", F.char_length("word"))
    return spread.mapInArrow(run, "a string, a_n long, b string, b_n long")


def _deletions(word: Column) -> Column:
    """Keys of the word and of each word that is left without one code point; near words share one at least."""
    cut = F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.concat(
        F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.char_length(word))))
    return F.transform(F.array_distinct(F.concat(F.array(word), cut)), lambda w: F.xxhash64(F.lit("-"), w))


def _once(pairs: DataFrame) -> DataFrame:
    """Every pair once; lists give it in either order."""
    a, b = F.struct(F.col("a").alias("w"), F.col("a_n").alias("n")), F.struct(F.col("b").alias("w"), F.col("b_n").alias("n"))
    return pairs.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct().select(
        F.col("x.w").alias("a"), F.col("x.n").alias("a_n"), F.col("y.w").alias("b"), F.col("y.n").alias("b_n"))


def near_words(words: DataFrame, often: int = OFTEN, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of distinct words one edit apart, once, from ``(word, n)`` of distinct words.

    A list of over ``cell_limit`` words is not gathered: its words are dealt out again by deletion variants.
    """
    dictionary, _ = gram_dictionary(words, often)
    # bounded by FREQUENT; frequent grams rank by their number, so that lists of rare ones are merged first
    frequent = {r["gram"]: r["n"] for r in dictionary.toLocalIterator()}
    keyed = stage(_index(words, frequent), "lists")
    hot = stage(keyed.groupBy("cell").count().where(F.col("count") > cell_limit).select("cell"), "hot_lists")
    if hot.isEmpty():
        return _once(_merged(keyed))
    members = keyed.join(hot, "cell", "left_semi").drop("cell").dropDuplicates(["word"])
    dealt = members.select(F.explode(_deletions(F.col("word"))).alias("cell"), "word", "n", "signature", "most")
    found = _merged(keyed.join(hot, "cell", "left_anti")).union(_merged(dealt))
    return _once(found)


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` rows: the last word that forms lead to.

    A form is more frequent than its word, tenfold here, so chains end and their doubling takes a few rounds; each
    is a table in the shared folder.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("from"), F.col("root").alias("to"))
        moved = at.join(step, F.col("root") == F.col("from"), "left")
        if moved.where("to IS NOT NULL").isEmpty():
            return at
        at = stage(moved.select("word", F.coalesce("to", "root").alias("root")), "roots")


def spelling_variants(words: DataFrame, ratio: int = 10, often: int = OFTEN, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``(word, n)``.

    ``form`` is the near word (one edit away) of the largest ``n``, the least in code-point order among equals, if it
    has ``ratio`` times the word's ``n`` or more, else NULL; ``root`` is where forms lead in the end, the word itself
    if it has none; ``n_near`` counts near words. Words that are NULL or empty don't take part and don't come back;
    repeated words are added up; an empty table gives no rows; further columns are ignored.
    """
    words = stage(words.where("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    pairs = near_words(words, often, cell_limit)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("of"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("of"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("of").agg(F.count("*").alias("n_near"),
                                  F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near"))).alias("best"))
    placed = words.join(best, F.col("word") == F.col("of"), "left")
    taken = -F.col("best.down") >= ratio * F.col("n")
    marked = stage(placed.select(
        "word", F.when(taken, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, -F.col("best.down")).alias("form_n")), "forms")
    ends = roots(marked.where("form IS NOT NULL")).select(F.col("word").alias("of"), "root")
    return marked.join(ends, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
