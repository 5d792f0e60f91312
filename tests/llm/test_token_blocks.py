import random

import numpy as np
import public_tokenizers
import pytest
from edge import TEXTS, edge_docs, empty_docs
from tokenizers import Tokenizer

from ferrycraft.llm import token_blocks as b

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("most", [1, 2, 50257, 1 << 32])
def test_blocks_round_trip(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n).astype(np.uint32)
    ids[rng.random(n) < 0.03] = rng.integers(0, 1 << 32)
    data = b.pack(ids)
    assert (b.unpack(data) == ids).all() and len(b.unpack(data)) == n
    for i in range(-(-n // b.BLOCK)):
        assert (b.block(data, i) == ids[i * b.BLOCK:(i + 1) * b.BLOCK]).all()


def test_outliers_stay_out_of_the_width():
    ids = np.full(b.BLOCK, 1000, np.uint32)
    ids[::2] = 1003
    ids[7] = 1 << 31
    assert len(b.pack(ids)) < 12 + 8 + 8 + b.BLOCK // 4 + 16


def test_broken_files_are_refused():
    data = b.pack(np.arange(1000, dtype=np.uint32))
    with pytest.raises(ValueError):
        b.unpack(b"XXXX" + data[4:])
    with pytest.raises(ValueError):
        b.unpack(data[:-3])


@pytest.mark.parametrize("seed", range(2))
def test_chunks_equal_whole_texts(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(b, "TABLE_CHARS", 2000)
    texts = ["".join(rng.choice(" \n\ta b cé.,'s1日　\x1c\x85") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["foo <|endoftext|> bar", "<|endoftext|>", " x", "x ", "", "a  b", "a\n b", "it's a don't 123abc 4 5"]
    encoder = b.Encoder(PATH)
    assert encoder.splits
    for low in range(0, len(texts), 100):
        part = texts[low:low + 100]
        assert [i.tolist() for i in encoder.encode(part)] == [whole(t) for t in part]


def test_files_and_edges(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tokens")
    b.write_tokens(edge_docs(spark), path, PATH, 2)
    rows = sorted(b.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    source = edge_docs(spark).collect()
    assert len(rows) == len(TEXTS) + 2 and rows[0]["doc_id"] is None
    keys = [r["doc_id"] for r in rows]
    assert keys[1:] == sorted(keys[1:])
    start = 0
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert ids in [[*whole(r["text"]), 2] for r in source if r["doc_id"] == row["doc_id"]]
        start += len(ids)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    b.write_tokens(empty_docs(spark), path, PATH, 2)
    assert b.read_tokens(spark, path).count() == 0
