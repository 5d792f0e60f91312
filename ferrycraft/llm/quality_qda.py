"""Quality scores by regularised quadratic discriminant analysis of transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import Block, blocks, hashed_sample, texts_of, with_columns
from ferrycraft.session import stage

FOLDS = 5
#: Share of the scaled identity in each class covariance.
SHRINKAGE = 0.1
THRESHOLD = 0.3
#: Learned rows, about, those with the lowest hash of their key, that the scale of the scores is fitted on.
CALIBRATION_ROWS = 10000

STATISTICS = ("bytes", "words", "word_bytes", "lines", "capitals", "symbols", "pipes", "shouts", "digits", "other_marks",
              "wide", "distinct", "echoes", "repeated_lines")


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


_CLASSES = {"space": _flags(b"\t\n\v\f\r "), "breaks": _flags(b"\n"), "capitals": _flags(bytes(range(65, 91))),
            "letters": _flags(bytes([*range(65, 91), *range(97, 123)])), "symbols": _flags(b"#*$%&<>@^~=+_\\"),
            "pipes": _flags(b"|"), "shouts": _flags(b"!"), "digits": _flags(b"0123456789"),
            "other_marks": _flags(b".,:;?'\"()[]{}/-"), "wide": _flags(bytes(range(128, 256)))}


def statistics(block: Block) -> np.ndarray:
    """A row of transformed statistics for every text; shares per word or byte are taken to their square root."""
    counts = {}
    for name, flags in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(flags[block.data], dtype=np.int64)])
        counts[name] = sums[block.bounds[1:]] - sums[block.bounds[:-1]]
    size = np.diff(block.bounds)
    words, distinct, echoes, repeated = (np.zeros(len(block)) for _ in range(4))
    for i, text in enumerate(block.texts()):
        own = text.split()
        words[i], distinct[i] = len(own), len(set(own))
        echoes[i] = sum(map(bytes.__eq__, own, own[1:]))
        lines = text.split(b"\n")
        repeated[i] = len(lines) - len(set(lines))
    per_word, per_byte = np.maximum(1, words), np.maximum(1, size)
    made = {"bytes": np.log1p(size), "words": np.log1p(words), "word_bytes": np.log1p((size - counts["space"]) / per_word),
            "lines": np.sqrt(counts["breaks"] / per_word), "capitals": np.sqrt(counts["capitals"] / np.maximum(1, counts["letters"])),
            "distinct": np.log(np.maximum(1, distinct) / per_word), "echoes": np.sqrt(echoes / per_word),
            "repeated_lines": np.sqrt(repeated / (1 + counts["breaks"])), "wide": np.sqrt(counts["wide"] / per_byte),
            "digits": np.sqrt(counts["digits"] / per_byte)}
    made |= {name: np.sqrt(counts[name] / per_word) for name in ("symbols", "pipes", "shouts", "other_marks")}
    return np.stack([made[name] for name in STATISTICS], axis=1)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, statistics)`` for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            flat = pa.array(statistics(block).ravel())
            ends = np.arange(0, (len(block) + 1) * len(STATISTICS), len(STATISTICS), dtype=np.int32)
            yield with_columns(block, [key], statistics=pa.ListArray.from_arrays(ends, flat))

    source = texts_of(docs, key, text=text)
    return source.mapInArrow(run, source.select(key, F.array(F.lit(0.0)).alias("statistics")).schema)


@dataclass
class Discriminant:
    """Of classes 0 and 1: means, inverse Cholesky factors of the covariances, log-determinants and log shares.

    ``slope`` and ``shift`` turn the difference of log-densities into the log-odds of class 1.
    """

    means: np.ndarray
    factors: np.ndarray
    logs: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Mahalanobis log-density under class 1 less that under class 0."""
        density = []
        for mean, factor, log in zip(self.means, self.factors, self.logs):
            density.append(log - 0.5 * (((rows - mean) @ factor.T) ** 2).sum(axis=1))
        return density[1] - density[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.slope * self.difference(rows) - self.shift, -700, 700)))

    def calibrated(self, rows: np.ndarray, classes: np.ndarray) -> Discriminant:
        """Slope and shift by logistic regression on smoothed targets (Platt's scaling), in Newton steps.

        Densities far from Gaussian tails are too sure of themselves; this sets the scores between the classes.
        """
        ones = int(classes.sum())
        target = np.where(classes == 1, (ones + 1) / (ones + 2), 1 / (len(classes) - ones + 2))
        values = self.difference(rows)
        unit = np.abs(values).mean() or 1.0
        inputs, theta = np.stack([values / unit, np.ones(len(values))], axis=1), np.array([1.0, 0.0])

        def loss(theta: np.ndarray) -> float:
            odds = inputs @ theta
            return float((np.logaddexp(0, odds) - target * odds).sum())

        for _ in range(100):
            odds = 1 / (1 + np.exp(-np.clip(inputs @ theta, -700, 700)))
            curve = (inputs * (odds * (1 - odds))[:, None]).T @ inputs + 1e-6 * np.eye(2)
            step, size, before = np.linalg.solve(curve, inputs.T @ (odds - target)), 1.0, loss(theta)
            while size > 1e-6 and loss(theta - size * step) > before:
                size /= 2
            theta = theta - size * step
            if np.abs(size * step).max() < 1e-6:
                break
        return Discriminant(self.means, self.factors, self.logs, max(theta[0] / unit, 1e-9), theta[1])


def discriminant(counts: np.ndarray, sums: np.ndarray, products: np.ndarray,
                 shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit from each class's count, sums and sums of products; covariances shrink on the pooled scale."""
    means = sums / counts[:, None]
    spread = products / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.einsum("c,cii->i", counts, spread) / counts.sum()
    scale = np.sqrt(np.maximum(pooled, 1e-9))
    factors, logs = [], []
    for count, own in zip(counts, spread):
        scaled = own / np.outer(scale, scale)
        level = max(np.trace(scaled) / len(scaled), 1e-6)
        root = np.linalg.cholesky((1 - shrinkage) * scaled + shrinkage * level * np.eye(len(scaled)))
        factors.append(np.linalg.inv(root) / scale)
        logs.append(np.log(count / counts.sum()) - np.log(np.diag(root)).sum())
    return Discriminant(means, np.stack(factors), np.array(logs))


def held_out(key: Column, folds: int = FOLDS) -> Column:
    """Whether a row belongs to the fold that is never learned from; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
        shrinkage: float = SHRINKAGE) -> Discriminant | float:
    """Learn from all labelled rows of ``measured`` outside the held-out fold.

    Each task sums its rows' moments, Spark adds them up, and a few hundred numbers reach the driver, with the
    statistics of about ``CALIBRATION_ROWS`` rows that set the scale of the scores. With
    fewer than two rows of a class there is no density to learn: the result is then the share of class 1.
    """
    width = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, width)
            classes = batch.column(0).to_numpy()
            for c in (0, 1):
                own = values[classes == c]
                moments[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], moments.shape[1])), pa.array(np.tile(np.arange(moments.shape[1]), 2)),
             pa.array(moments.ravel())], names=["class", "place", "amount"])

    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(key).alias("of"), F.col(label).cast("int").alias("class"))
    seen = rows.where(~held_out(F.col(key))).join(known, F.col(key) == F.col("of"))
    total = np.zeros((2, 1 + width + width * width))
    for c, place, amount in seen.select("class", "statistics").mapInArrow(run, "class long, place long, amount double").groupBy(
            "class", "place").agg(F.sum("amount")).collect():
        total[c, place] = amount
    counts = total[:, 0]
    if counts.min() < 2:
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    model = discriminant(counts, total[:, 1:1 + width], total[:, 1 + width:].reshape(2, width, width), shrinkage)
    sample = sorted(tuple(r) for r in hashed_sample(seen, "of", CALIBRATION_ROWS).select("class", "statistics").collect())
    return model.calibrated(np.array([own for _, own in sample]), np.array([c for c, _ in sample]))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  shrinkage: float = SHRINKAGE, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, held_out, score, predicted)`` for every row of ``docs``.

    Only statistics of the text enter a score. They are computed once and written to the shared folder, as
    learning and scoring both read them. NULL and empty texts have the statistics of no words; documents or
    labels that repeat a key count each; rows with a NULL key are scored but not learned from; without labels of
    both classes all scores are the share of class 1, or 0.5; further columns are ignored.
    """
    rows = stage(measured(docs, key, text), "statistics")
    model = fit(rows, labels, key, label, shrinkage)
    width = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, width)
            score = model.score(values) if isinstance(model, Discriminant) else np.full(len(values), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=[key, "score"])

    scored = rows.mapInArrow(run, rows.select(key, F.lit(0.0).alias("score")).schema)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
