"""Texts as blocks of UTF-8 bytes inside a task: the common ground of the operators that run Python on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


@dataclass
class Block:
    """Consecutive rows of a batch: text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    rows: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def texts(self) -> list[bytes]:
        whole = self.data.tobytes()
        ends = self.bounds.tolist()
        return [whole[a:b] for a, b in zip(ends, ends[1:])]


def texts_of(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and the text, NULL as the empty text; other columns never leave the scan."""
    return docs.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut batches with a ``text`` column into blocks of about ``size`` bytes; every row comes once."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        if not len(column):
            continue
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        low = 0
        while low < len(column):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + size, "right")) - 1)
            yield Block(batch.slice(low, high - low), data[ends[low]:ends[high]], ends[low:high + 1] - ends[low])
            low = high


def with_columns(block: Block, names: list[str], **columns) -> pa.RecordBatch:
    """The named columns of the block's rows, then new ones."""
    kept = [block.rows.column(block.rows.schema.get_field_index(n)) for n in names]
    made = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(kept + made, names=names + list(columns))


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows (all, when there are fewer): those whose key's hash is lowest, the same in every run.

    A threshold on the hash, from one count, and no sorting: tasks send the driver nothing but the chosen rows.
    """
    share = min(1.0, most / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(share * (1 << 40)))


def slots(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
