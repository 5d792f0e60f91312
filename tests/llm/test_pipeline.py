"""Every stage of the pipeline against plain Python over all rows of a small table."""

import numpy as np
import pytest
from edge import with_clashes
from pyspark.sql import functions as F
from test_fm_decontam import plain as plain_passages
from test_line_quality import plain as plain_counts
from test_piece_codec import LIBRARY, whole
from test_near_copies import plain_kept
from test_secret_scan import plain_base

import corpus_pipeline
from ferrycraft.llm import line_quality

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    """The table with awkward rows: NULL and empty texts, repeats, a NULL key."""
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    more = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "x", 0), (9003, "tiny", "en", "x", 4),
         (None, "word " * 5 + " ".join(f"own{i}" for i in range(80)) + " token = abcdef99", "en", "x", 1)], base.schema)
    rows = base.union(base.where("doc_id = 5")).union(more)
    return spark.createDataFrame(rows.collect(), base.schema)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def plain_viterbi(field, features):
    best, back = {}, []
    for t, row in enumerate(features):
        own = {0: 0.0, 1: float(row @ field.weights)}
        step = {y: max((0, 1), key=lambda x: best[x] + field.moves[x, y]) for y in own} if t else {}
        best = {y: own[y] + (best[step[y]] + field.moves[step[y], y] if t else 0) for y in own}
        back.append(step)
    path = [max(best, key=best.get)] if back else []
    for step in reversed(back[1:]):
        path.append(step[path[-1]])
    return path[::-1]


def test_quality_rules(spark, docs):
    kept = STAGES["quality_rules"](spark, docs, SF_DIR)
    assert kept.columns == COLUMNS
    field = line_quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    want = []
    from types import SimpleNamespace
    for key, text in texts(docs):
        data = (text or "").encode()
        block = SimpleNamespace(data=np.frombuffer(data, np.uint8), bounds=np.array([0, len(data)]), texts=lambda d=data: [d])
        found = line_quality.measure(block)
        labels = plain_viterbi(field, found.features)
        words, failed = plain_counts(text)[0], plain_counts(text)[-1]
        if not failed and sum(found.line_words[i] for i, y in enumerate(labels) if y) >= 0.5 * words:
            want.append((key, text))
    assert sorted(texts(kept), key=repr) == sorted(want, key=repr)


def test_simhash_near_dedup(spark, docs):
    """One document of every group linked by a five-word similarity of 0.8 or more, by all pairs."""
    rows = [(k, t) for k, t in texts(docs) if k is not None]
    out = STAGES["simhash_near_dedup"](spark, docs, SF_DIR)
    assert out.columns == COLUMNS
    assert sorted(k for k, _ in texts(out) if k is not None) == sorted(rows[i][0] for i in plain_kept(rows))
    assert sum(k is None for k, _ in texts(out)) == 1


def test_benchmark_decontamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {w for _, passage in items for w in _windows(passage)}
    want = [(k, t or "") for k, t in texts(docs) if not windows & set(_windows(t))]
    out = STAGES["benchmark_decontamination"](spark, docs, SF_DIR)
    assert out.columns == COLUMNS and sorted(texts(out), key=repr) == sorted(want, key=repr)
    assert len(want) < docs.count()
    some = next(t for k, t in texts(docs) if t and windows & set(_windows(t)))
    assert plain_passages(some, items, 10)[1] > 0


def _windows(text, width=10):
    import test_fm_decontam

    words = test_fm_decontam.words(text)
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def test_secret_scans(spark, docs):
    out = STAGES["secret_scans"](spark, docs, SF_DIR)
    assert out.columns == COLUMNS
    want = []
    for key, text in texts(docs):
        masked, at = "", 0
        for start, end, _ in plain_base(text or ""):
            if start > at or not at:
                masked += (text or "")[at:start] + "[SECRET]"
            at = max(at, end)
        want.append((key, masked + (text or "")[at:]))
    assert sorted(texts(out), key=repr) == sorted(want, key=repr)
    assert out.where("n_chars <> length(text)").count() == 0


def test_sentencepiece_codec(spark, docs):
    source = dict(texts(docs))
    for row in STAGES["sentencepiece_codec"](spark, docs, SF_DIR).collect():
        ids = whole(source[row["doc_id"]])
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids and row["n_tokens"] == len(ids)
        assert row["text"] == LIBRARY.decode(ids)


@pytest.mark.parametrize("name", list(STAGES))
def test_other_columns_and_no_rows(spark, docs, name):
    wide = with_clashes(docs.limit(30))
    out = STAGES[name](spark, wide, SF_DIR)
    assert name == "sentencepiece_codec" or out.columns == wide.columns
    assert STAGES[name](spark, wide.where("false"), SF_DIR).count() == 0


def test_run(spark):
    """The whole pipeline is its stages one after the other."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF_DIR)
    out = corpus_pipeline.run(spark, SF_DIR)
    digest = F.sha2("ids", 256).alias("ids")
    assert sorted(out.select("doc_id", digest).collect()) == sorted(docs.select("doc_id", digest).collect())
    assert out.count() > 100
