import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge import TEXTS, edge_docs, empty_docs

from ferrycraft.llm import piece_codec as p

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def whole(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


@pytest.mark.parametrize("seed", range(3))
def test_chunks_equal_whole_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(" ▁\n\ta bé日🙂　\x00.") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    codec = p.Codec(MODEL)
    assert codec.splits
    assert codec.encode(texts) == [whole(t) for t in texts]


def test_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(p, "TABLE_CHARS", 5)
    codec = p.Codec(MODEL)
    for text in ("a few words", "some other words", "a few words"):
        assert codec.encode([text]) == [whole(text)]


def test_models_whose_pieces_cross_markers_take_whole_texts():
    codec = p.Codec(MODEL)
    codec.splits = False
    assert codec.encode(["a  b c", ""]) == [whole("a  b c"), whole("")]


def test_edges_and_decoding(spark):
    docs = edge_docs(spark)
    coded = p.encode(docs, MODEL, decoded=True)
    want = {}
    for row in docs.collect():
        want.setdefault(row["doc_id"], row["text"])
    got = coded.collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        ids = whole(want[row["doc_id"]])
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["decoded"] == LIBRARY.decode(ids)
    again = {r["doc_id"]: r["decoded"] for r in p.decode(coded, MODEL).collect()}
    assert again == {r["doc_id"]: r["decoded"] for r in got}
    assert p.encode(empty_docs(spark), MODEL).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert p.decode(nothing, MODEL).first()["decoded"] == ""


def test_a_task_leaves_no_table_behind():
    """A worker that goes on to other work holds no chunks; while it encodes, ids are held packed."""
    codec = p.Codec(MODEL)
    packed = codec.packed(["some words  here", ""])
    assert [np.frombuffer(i, "<u4").tolist() for i in packed] == [whole("some words  here"), whole("")]
    assert codec.table and all(isinstance(i, bytes) for i in codec.table.values())
    codec.clear()
    assert not codec.table and codec.held == 0


def test_workers_tables_are_empty_after_a_query(spark):
    import pyarrow as pa

    def held(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": [len(p.codec(MODEL).table)]})

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string").repartition(8)
    assert p.encode(docs, MODEL).count() == 20
    p.encode(docs, MODEL).write.format("noop").mode("overwrite").save()
    assert {r["n"] for r in spark.range(16).repartition(8).mapInArrow(held, "n long").collect()} == {0}
