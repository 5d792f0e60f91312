"""SentencePiece encoding through a table of distinct chunks, and decoding.

The model marks white space with U+2581 and no piece holds a marker after another character, so no merge
crosses from a word into the next marker. A text is then the sequence of its chunks (markers with the word behind
them); every distinct chunk is segmented once and its ids are put back wherever the chunk stands.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, texts_of, with_columns

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Characters of chunks that a worker's table holds before it starts anew; results don't depend on it.
TABLE_CHARS = 4 << 20
#: Bytes of text taken at a time.
TAKEN_BYTES = 1 << 20


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


class Codec:
    """One model in one worker: its chunk table and the library's decoder."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        probe = "a  b  c\td́e\r\n"
        self.splits &= self.model.encode(probe, out_type=str) == [
            p for c in self.chunks(probe) for p in self.model.encode(c[1:], out_type=str) or [c]]
        self.bare = [self.model.piece_to_id(MARK)]
        self.table: dict[str, bytes] = {}
        self.held = 0

    @staticmethod
    def chunks(text: str) -> list[str]:
        return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def clear(self) -> None:
        self.table.clear()
        self.held = 0

    def packed(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text, with begin and end ids, as little-endian unsigned 32-bit integers."""
        begin, end = _packed([self.model.bos_id()]), _packed([self.model.eos_id()])
        if not self.splits:  # pieces may cross markers: whole texts are segmented
            return [begin + _packed(ids) + end for ids in self.model.encode(texts, num_threads=1)]
        split = [self.chunks(t) for t in texts]
        if self.held > TABLE_CHARS:
            self.clear()
        fresh = list(set(chain.from_iterable(split)).difference(self.table))
        # The library sets a marker before every text, which stands for the first one of the chunk.
        ids = self.model.encode([c[1:] for c in fresh], num_threads=1) if fresh else []
        self.table.update((c, _packed(i or self.bare)) for c, i in zip(fresh, ids, strict=True))
        self.held += sum(map(len, fresh))
        find = self.table.__getitem__
        return [begin + b"".join(map(find, s)) + end for s in split]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of each text, with begin and end ids."""
        return [_ids(i) for i in self.packed(texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids) if ids else []


@functools.lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``(key, ids)`` for every row, with ``decoded`` also the text that the ids decode to.

    ``ids`` are little-endian unsigned 32-bit integers in a binary value, equal to the library's for the whole text,
    begin and end ids included. NULL and empty texts give these two ids and decode to the empty text; a text
    without white space is one chunk; repeated rows and NULL keys are kept; further columns are ignored.
    ``model`` is a path that the workers can read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        try:
            for block in blocks(batches, TAKEN_BYTES):
                ids = own.packed([t.decode() for t in block.texts()])
                made = {"ids": pa.array(ids, pa.binary())}
                if decoded:
                    made["decoded"] = pa.array([own.model.decode(_ids(i)) for i in ids], pa.string())
                yield with_columns(block, [key], **made)
        finally:  # the worker outlives the task, and may have other work next
            own.clear()

    source = texts_of(docs, key, text=text)
    made = {"ids": F.lit(b"")} | ({"decoded": F.lit("")} if decoded else {})
    return source.mapInArrow(run, source.select(key, *(v.alias(k) for k, v in made.items())).schema)


def decode(encoded: DataFrame, model: str, key: str = "doc_id") -> DataFrame:
    """``(key, decoded)``: the text of every row's ``ids``; NULL counts as no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            ids = [_ids(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.decode(ids), pa.string())],
                                             names=[key, "decoded"])

    source = encoded.select(key, "ids")
    return source.mapInArrow(run, source.select(key, F.lit("").alias("decoded")).schema)
