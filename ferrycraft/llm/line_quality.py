"""Quality rules: whole-text counts, and a linear-chain conditional random field that tells content from boilerplate.

The field labels the lines of a text; it is trained on a bounded sample of labelled documents, whose lines take
the document's label, and decoded with Viterbi's algorithm. The share of words in content lines decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import Block, blocks, hashed_sample, texts_of, with_columns

SYMBOLS = b"#*$%&|<>"
SPACE = b"\t\n\v\f\r "
#: Labelled documents, about, that the field is trained on: those with the lowest hash of their key.
TRAIN_DOCS = 2000
#: Lines of a training sequence; longer documents give several.
TRAIN_LINES = 64
STEPS, RATE, PENALTY = 250, 0.1, 1e-4
#: A text is kept when content lines hold at least this share of its words.
CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Bytes of text judged at a time: sums over all characters take several times as much.
JUDGED_BYTES = 1 << 20

FEATURES = ("bias", "symbols", "capitals", "pipes", "shouts", "echoes", "digits", "closed", "length", "short",
            "repeated", "first", "last", "word_length")


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


IS_SPACE, IS_SYMBOL = _flags(SPACE), _flags(SYMBOLS)
COUNTED = {"symbols": IS_SYMBOL, "capitals": _flags(bytes(range(65, 91))), "letters": _flags(bytes([*range(65, 91), *range(97, 123)])),
           "pipes": _flags(b"|"), "shouts": _flags(b"!"), "digits": _flags(b"0123456789")}
CLOSING = _flags(b".!?:;\"')")


def repeated_words(ids: np.ndarray) -> int:
    """Words in three-word windows that stand in the text twice or more."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    key = ids[:-1] * size + ids[1:]
    if size >= 1 << 21:
        key = np.unique(key, return_inverse=True)[1]
    _, window, counts = np.unique(key[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[window] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= twice
    return int(covered.sum())


@dataclass
class Measured:
    """Counts of every text of a block, and its lines that have a word: feature rows and words of each."""

    counts: dict[str, np.ndarray]
    line_ends: np.ndarray  # lines of text i: line_ends[i] … line_ends[i + 1]
    features: np.ndarray
    line_words: np.ndarray


def measure(block: Block) -> Measured:
    data, bounds = block.data, block.bounds

    def total(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[high] - sums[low]

    space = IS_SPACE[data]
    breaks = np.flatnonzero(data == 10)
    low, high = np.sort(np.concatenate([bounds[:-1], breaks + 1])), np.sort(np.concatenate([breaks, bounds[1:]]))
    filled = total(1 - space, low, high) > 0
    low, high = low[filled], high[filled]
    begins = (1 - space).astype(bool)
    begins[1:] &= space[:-1].astype(bool) | np.isin(np.arange(1, len(data)), bounds, assume_unique=False)
    line_words = total(begins, low, high)
    chars = ((data & 0xC0) != 0x80) & (space == 0)
    line_ends = np.searchsorted(low, bounds, "left")
    counts = {"word_chars": total(chars, bounds[:-1], bounds[1:]),
              "n_symbols": total(IS_SYMBOL[data], bounds[:-1], bounds[1:])}

    n_words, n_dup, n_repeat, echoes, again = [], [], [], [], []
    for text in block.texts():
        words = text.split()
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        n_words.append(len(words))
        n_repeat.append(repeated_words(ids))
        echo = np.zeros(len(words), bool)
        echo[1:] = ids[1:] == ids[:-1]
        echoes.append(echo)
        lines = [line for line in text.split(b"\n") if line.strip()]
        seen: set[bytes] = set()
        own = [line in seen or seen.add(line) is not None for line in lines]
        n_dup.append(sum(own))
        again.append(own)
    counts |= {"n_words": np.array(n_words, np.int64), "n_dup_lines": np.array(n_dup, np.int64),
               "n_repeat_words": np.array(n_repeat, np.int64)}

    features = np.zeros((len(low), len(FEATURES)))
    if len(low):
        echo = np.concatenate(echoes)
        firsts = np.cumsum(line_words) - line_words
        echo[firsts] = False
        per = {name: total(flags[data], low, high) for name, flags in COUNTED.items()}
        end = high - 1
        while (blank := space[end] == 1).any():  # to the last character that is no white space
            end = end - blank
        place = {"bias": 1, "symbols": np.minimum(1, per["symbols"] / line_words),
                 "capitals": per["capitals"] / np.maximum(1, per["letters"]), "pipes": per["pipes"] / line_words,
                 "shouts": np.minimum(1, per["shouts"] / line_words),
                 "echoes": np.add.reduceat(echo, firsts, dtype=np.int64) / line_words,
                 "digits": per["digits"] / (high - low), "closed": CLOSING[data[end]],
                 "length": np.log1p(line_words) / 5, "short": line_words < 5,
                 "repeated": np.fromiter(chain.from_iterable(again), np.float64, len(low)),
                 "first": np.isin(np.arange(len(low)), line_ends[:-1]),
                 "last": np.isin(np.arange(len(low)), line_ends[1:] - 1),
                 "word_length": np.minimum(2, total(chars, low, high) / line_words / 10)}
        for column, name in enumerate(FEATURES):
            features[:, column] = place[name]
    return Measured(counts, line_ends, features, line_words)


@dataclass
class Field:
    """Score of a content line: ``weights`` times its features; ``moves[a, b]``: of label b after label a."""

    weights: np.ndarray
    moves: np.ndarray


def _aligned(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequences longest first: their starts, lengths, and how many have a t-th line."""
    order = np.argsort(-np.diff(ends), kind="stable")
    lengths = np.diff(ends)[order]
    longest = int(lengths[0]) if len(lengths) else 0
    return ends[:-1][order], lengths, np.searchsorted(-lengths, -np.arange(longest), "left").tolist()


def viterbi(field: Field, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The likeliest labels (1 content) of the lines of every sequence, all sequences step by step together."""
    score, (starts, lengths, active) = features @ field.weights, _aligned(ends)
    labels, back = np.zeros(len(features), np.int8), []
    best = np.zeros((len(lengths), 2))
    for t, n in enumerate(active):
        own = np.stack([np.zeros(n), score[starts[:n] + t]], axis=1)
        if t:
            reach = best[:n, :, None] + field.moves[None]
            back.append(reach.argmax(axis=1))
            best[:n] = reach.max(axis=1) + own
        else:
            best[:n] = own
    if not active:
        return labels
    state = best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        labels[starts[:n] + t] = state[:n]
        if t:
            state[:n] = back[t - 1][np.arange(n), state[:n]]
    return labels


def train(features: np.ndarray, labels: np.ndarray, ends: np.ndarray) -> Field:
    """Penalised maximum likelihood by forward-backward and Adam steps."""
    starts, lengths, active = _aligned(ends)
    theta, count = np.zeros(features.shape[1] + 4), max(1, len(features))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.ones(len(features), bool)
    inner[ends[:-1][np.diff(ends) > 0]] = False
    pairs = np.flatnonzero(inner)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (labels[pairs - 1], labels[pairs]), 1)
    seen = np.concatenate([features.T @ labels, seen_moves.ravel()])
    for step in range(1, STEPS + 1):
        score, moves = features @ theta[:-4], theta[-4:].reshape(2, 2)
        own = np.stack([np.zeros(len(score)), score], axis=1)
        ahead, behind = own.copy(), np.zeros_like(own)
        for t, n in enumerate(active[1:], 1):
            at = starts[:n] + t
            ahead[at] += np.logaddexp.reduce(ahead[at - 1][:, :, None] + moves[None], axis=1)
        for t in range(len(active) - 1, 0, -1):
            at = starts[:active[t]] + t
            behind[at - 1] = np.logaddexp.reduce(moves[None] + (own[at] + behind[at])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(ahead + behind, axis=1)
        content = np.exp(ahead[:, 1] + behind[:, 1] - whole)
        joint = np.exp(ahead[pairs - 1][:, :, None] + moves[None] + (own + behind)[pairs][:, None, :]
                       - whole[pairs][:, None, None]).sum(axis=0)
        slope = (np.concatenate([features.T @ content, joint.ravel()]) - seen) / count + PENALTY * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        theta = theta - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        most: int = TRAIN_DOCS) -> Field | None:
    """Train on about ``most`` labelled documents; None when no label meets a document.

    Only these documents' line features reach the driver. Rows with a NULL key or label are left out of training;
    a key with several labels or rows gives several sequences.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("of"), F.col(label).cast("int").alias("label"))
    chosen = hashed_sample(known, "of", most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = measure(block)
            rows = [found.features[a:b].tobytes() for a, b in zip(found.line_ends, found.line_ends[1:])]
            yield with_columns(block, ["of", "label"], lines=pa.array(rows, pa.binary()))

    matched = docs.select(F.col(key).alias("own"), F.col(text)).join(
        F.broadcast(chosen), F.col("own") == F.col("of"))
    rows = texts_of(matched, "of", "label", text=text).mapInArrow(
        run, known.withColumn("lines", F.lit(b"")).schema).collect()
    parts, tags = [], []
    for row in sorted(rows, key=lambda r: (str(r["of"]), r["label"], bytes(r["lines"]))):
        lines = np.frombuffer(row["lines"]).reshape(-1, len(FEATURES))
        for at in range(0, len(lines), TRAIN_LINES):
            parts.append(lines[at:at + TRAIN_LINES])
            tags.append(np.full(len(parts[-1]), row["label"] == 1, np.int64))
    if not parts:
        return None
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return train(np.concatenate(parts), np.concatenate(tags), ends)


def judge(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text",
          share: float = CONTENT_SHARE, keep_text: bool = False) -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content, content_words, kept)``.

    Words are stretches without ASCII white space. ``content`` has a flag for each line that has a word. A text
    of fewer than 50 words, or with over half of them in repeated three-word windows, fails; any other is kept when
    content lines hold the share of its words. Without a field all lines count as content. NULL and empty texts have
    no words and fail; repeated rows and NULL keys are kept apart; further columns are ignored. With ``keep_text``
    the text, NULL as empty, comes second.
    """
    kept_columns = [key, "text"] if keep_text else [key]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, JUDGED_BYTES):
            found = measure(block)
            ends = found.line_ends
            labels = (viterbi(field, found.features, ends) if field is not None
                      else np.ones(len(found.features), np.int8))
            sums = np.concatenate([[0], np.cumsum(found.line_words * labels)])
            content, words = sums[ends[1:]] - sums[ends[:-1]], found.counts["n_words"]
            failed = (words < MIN_WORDS) | (100 * found.counts["n_repeat_words"] > MAX_REPEAT_PERCENT * words)
            yield with_columns(
                block, kept_columns, **{n: found.counts[n] for n in names}, base_failed=failed,
                content=pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(labels.astype(bool))),
                content_words=content, kept=~failed & (content >= share * words))

    source = texts_of(docs, key, text=text)
    zero, flag = F.lit(0).cast("long"), F.lit(True)
    return source.mapInArrow(run, source.select(
        *kept_columns, *(zero.alias(n) for n in names), flag.alias("base_failed"), F.array(flag).alias("content"),
        zero.alias("content_words"), flag.alias("kept")).schema)
