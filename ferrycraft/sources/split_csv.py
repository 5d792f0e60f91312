"""CSV with line breaks inside quotes, read by as many tasks as its bytes make splits.

Whether a line break ends a record depends on the quotes before it. A first pass counts the quotes of every split; their
parities, added up from the start of a file, tell which splits begin inside a quoted value. A second pass cuts each
split into records from its first true boundary. Only the pieces of records that run over the end of a split, two a
split at most, are put together in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: what a quoted value starts and ends with, doubled inside.
QUOTE = '"'
#: Bytes of records that a task passes on at a time, about.
BATCH_BYTES = 8 << 20


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in file order inside each split, with the split's place and the number of quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    count = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("start"), count.alias("quotes"))


def split_states(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, inside``: whether each split begins inside a quoted value; one row a split."""
    parities = _lines(spark, path).groupBy("file", "start").agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parities.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Cutter:
    """Cuts the lines of one split after another into records."""

    def __init__(self, inside: set[tuple[str, int]]):
        self.inside, self.at = inside, None
        self.rows: list[tuple] = []
        self.bytes = 0

    def begin(self, at: tuple[str, int]) -> None:
        self.close()
        self.at, self.open = at, at in self.inside
        self.begun, self.held, self.first = not self.open, [], at[1] == 0

    def emit(self, whole: bool) -> None:
        text = "\n".join(self.held)
        self.rows.append((text, *self.at, whole, self.begun, self.first and self.begun))
        self.bytes += len(text)
        if self.begun:
            self.first = False
        self.held, self.begun = [], True

    def close(self) -> None:
        """The end of the split: what is held is a piece of a record that goes on."""
        if self.at is not None and (self.held or not self.begun):
            self.emit(False)

    def take(self, lines: list[str], quotes: np.ndarray) -> None:
        inside = (np.cumsum(quotes) + self.open) % 2 == 1
        low = 0
        for end in np.flatnonzero(~inside):
            self.held += lines[low:end + 1]
            self.emit(self.begun)
            low = end + 1
        self.held += lines[low:]
        self.open = bool(inside[-1])

    def made(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 6
        self.rows, self.bytes = [], 0
        kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["text", "file", "start", "whole", "begun", "first"])


def csv_records(spark: SparkSession, path: str, header: bool = True, line_sep: str = "\n") -> DataFrame:
    """``text``: one CSV record a row, without empty lines and without the first record of each file if ``header``.

    Quotes are doubled inside quoted values and appear nowhere else. The list of splits that begin inside quotes is sent
    to the tasks: one entry a split at most, 800,000 for 100 TB in splits of 128 MB.
    """
    inside = {(r["file"], r["start"]) for r in split_states(spark, path).where("inside").toLocalIterator()}
    known = spark.sparkContext.broadcast(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(known.value)
        for batch in batches:
            if not len(batch):
                continue
            values, files = batch.column(0).to_pylist(), batch.column(1)
            starts, quotes = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            files = files.dictionary_encode()
            codes = files.indices.to_numpy()
            edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
            for low, high in zip([0, *edges], [*edges, len(values)]):
                at = files.dictionary[int(codes[low])].as_py(), int(starts[low])
                if at != cutter.at:
                    cutter.begin(at)
                cutter.take(values[low:high], quotes[low:high])
                if cutter.bytes > BATCH_BYTES:
                    yield cutter.made()
        cutter.close()
        yield cutter.made()

    cut = _lines(spark, path).mapInArrow(run, "text string, file string, start long, whole boolean, begun boolean, first boolean")
    whole = cut.where("whole").select("text", "first")
    pieces = cut.where("NOT whole")
    order = Window.partitionBy("file").orderBy("start", "begun")
    joined = pieces.withColumn("record", F.sum(F.col("begun").cast("int")).over(order)).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "begun", "text"))).alias("parts"), F.max("first").alias("first"))
    records = whole.union(joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n"), "first"))
    if header:
        records = records.where("NOT first")
    text = F.regexp_replace("text", "\r$", "") if line_sep == "\r\n" else F.col("text")
    return records.select(text.alias("text")).where("text <> ''")
