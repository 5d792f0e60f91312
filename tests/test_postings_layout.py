"""Postings with positions, searches, and files clustered by several columns."""

import datetime
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrycraft.operators import layout
from ferrycraft.operators import postings as p


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 100):
        docs = np.sort(rng.choice(1 << 40, n, replace=False)) - (1 << 39)
        counts = rng.integers(1, 6, n)
        positions = np.concatenate([np.sort(rng.choice(1 << rng.integers(4, 33), c, replace=False)) for c in counts])
        found = p.unpack_block(int(docs[0]), p.pack_block(docs, counts, positions))
        assert all((a == b).all() for a, b in zip(found, (docs, counts, positions)))
    values = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 62], np.int64)
    assert (p._unpacked(p._packed(values)) == values).all() and len(p._unpacked(b"")) == 0


def made(seed, n=300):
    rng = random.Random(seed)
    words = ["new", "york", "city", "a", "b", "rare"]
    weight = [5, 5, 3, 20, 20, 0.05]
    return [(i * 3, rng.choice([None, "", "..."]) if i % 29 == 0 else " ".join(
        rng.choices(words, weight, k=rng.randrange(40))).replace("new", rng.choice(["New,", "new"]))) for i in range(n)]


@pytest.fixture(scope="module", params=[4, 128])
def index(spark, request, tmp_path_factory):
    rows = made(request.param)
    path = str(tmp_path_factory.mktemp("postings"))
    before, p.BLOCK_DOCS = p.BLOCK_DOCS, request.param
    df = spark.createDataFrame(rows, "`the.doc` long, `a.text` string").repartition(3)
    p.write_postings(df, "the.doc", "a.text", f"{path}/index", 4)
    p.BLOCK_DOCS = before
    texts = {k: [w for w in re.split(r"\W+", (t or "").lower()) if w] for k, t in rows}
    return spark.read.parquet(f"{path}/index/blocks"), spark.read.parquet(f"{path}/index/lengths"), texts, request.param


def test_blocks_are_bounded(index):
    blocks, lengths, texts, most = index
    assert blocks.agg(F.max("docs")).first()[0] <= most
    assert {r["doc"]: r["length"] for r in lengths.collect()} == {k: len(w) for k, w in texts.items() if w}
    assert blocks.where("term = 'a'").count() >= 290 * 0.5 / most
    found = {(r["term"], r["doc"]): r["positions"] for r in p.read_postings(blocks, ["rare", "city"]).collect()}
    assert found == {(t, k): [i for i, x in enumerate(w) if x == t] for t in ("rare", "city") for k, w in texts.items() if t in w}


@pytest.mark.parametrize("phrase", ["new york", "New York, CITY", "a a", "a b a", "rare", "rare a", "nothing", "new nothing", " ,", ""])
def test_phrases(index, phrase):
    blocks, _, texts, _ = index
    words = [w for w in re.split(r"\W+", phrase.lower()) if w]
    want = {k: sum(w[i:i + len(words)] == words for i in range(len(w))) for k, w in texts.items()} if words else {}
    assert {r["doc"]: r["hits"] for r in p.search_phrase(blocks, phrase).collect()} == {k: n for k, n in want.items() if n}


def test_blocks_of_common_terms_are_skipped(index):
    blocks, _, texts, most = index
    if most == 4:
        met = p.candidate_blocks(blocks, ["rare", "a"])
        assert met.where("term = 'a'").count() < blocks.where("term = 'a'").count()


@pytest.mark.parametrize("query, n", [("rare city", 5), ("a a new", 40), ("nothing", 3), ("", 3), ("city nothing", 400)])
def test_ranks(index, query, n):
    blocks, lengths, texts, _ = index
    terms = {w for w in re.split(r"\W+", query.lower()) if w}
    total, mean = sum(map(bool, texts.values())), sum(map(len, texts.values())) / sum(map(bool, texts.values()))
    holds = Counter(t for w in texts.values() for t in set(w) & terms)
    score = lambda w: sum(math.log(1 + (total - holds[t] + .5) / (holds[t] + .5)) * w.count(t) * 2.2 / (
        w.count(t) + 1.2 * (.25 + .75 * len(w) / mean)) for t in terms if t in w)
    want = sorted(((-round(score(w), 9), k) for k, w in texts.items() if set(w) & terms))[:n]
    got = [(-r["score"], r["doc"]) for r in p.search_ranked(blocks, lengths, query, n).collect()]
    assert [k for _, k in got] == [k for _, k in want] and all(abs(a[0] - b[0]) < 1e-8 for a, b in zip(got, want))


def test_several_columns_skip_files(spark, tmp_path):
    """Each column's filter reads a part of the files; clustering by one column helps that column only."""
    df = spark.range(40000).select(
        (F.hash("id") % 1000).alias("a"), F.concat(F.lit("k"), F.lpad((F.hash(F.col("id") + 7) % 500 + 500).cast("string"), 4, "0")).alias("b.b"),
        F.date_add(F.lit(datetime.date(2000, 1, 1)), (F.hash(F.col("id") * 3) % 2000).cast("int")).alias("c"))
    ranges = [("a", 10, 40), ("b.b", "k0100", "k0120"), ("c", datetime.date(2001, 1, 1), datetime.date(2001, 3, 1))]
    layout.write_multi_clustered(df, f"{tmp_path}/curve", ["a", "b.b", "c"], 64)
    layout.write_clustered(df, f"{tmp_path}/one", ["a"], 64)
    read = {name: {r["filter"]: r for r in layout.files_to_read(spark.read.parquet(f"{tmp_path}/{name}"), ["a"], ranges).collect()}
            for name in ("curve", "one")}
    assert all(r["rows_read"] < 0.55 * r["rows"] for r in read["curve"].values())
    assert read["one"]["a"]["rows_read"] < 0.1 * 40000
    assert all(read["one"][c]["rows_read"] > 0.9 * 40000 for c in ("b.b", "c"))
    back = spark.read.parquet(f"{tmp_path}/curve")
    assert back.columns == df.columns and back.exceptAll(df).isEmpty() and back.count() == 40000


def test_curve_of_hot_and_empty_columns(spark, tmp_path):
    df = spark.createDataFrame([(None, 1.0)] * 5 + [(3, None)] * 5 + [(3, 2.5)], "a int, b double")
    layout.write_multi_clustered(df, f"{tmp_path}/x", ["a", "b"], 3)
    assert spark.read.parquet(f"{tmp_path}/x").count() == 11
    layout.write_multi_clustered(df.limit(0), f"{tmp_path}/y", ["a", "b"], 3)
    with pytest.raises(ValueError):
        layout.write_multi_clustered(df, f"{tmp_path}/z", ["a", "b"], 3, bits=40)


def test_blocks_are_packed_as_one_by_one(spark, monkeypatch):
    """Whatever number of words is packed at a time; a document of several rows is one posting, its places count on."""
    rows = [(k % 17, " ".join(f"w{(k * i) % 7}" for i in range(k % 11))) for k in range(120)] + [(None, "w1"), (3, None)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(5)
    for held in (1, 40, 1 << 21):
        monkeypatch.setattr(p, "HELD_WORDS", held)
        blocks, lengths = p.build_postings(df, "k", "t")
        blocks, words = blocks.collect(), Counter((k, w) for k, t in rows if k is not None for w in (t or "").split())
        found, places = {}, {}
        for b in blocks:
            docs, counts, positions = p.unpack_block(b["first"], bytes(b["postings"]))
            assert bytes(b["postings"]) == p.pack_block(docs, counts, positions)
            assert (docs[0], docs[-1], len(docs)) == (b["first"], b["last"], b["docs"])
            ends = counts.cumsum()
            for d, low, high in zip(docs.tolist(), (ends - counts).tolist(), ends.tolist()):
                assert (d, b["term"]) not in found
                found[d, b["term"]] = high - low
                places.setdefault(d, []).extend(positions[low:high].tolist())
        assert found == words
        assert all(sorted(x) == list(range(len(x))) for x in places.values())
        assert {r["doc"]: r["length"] for r in lengths.collect()} == {d: len(x) for d, x in places.items()}


def test_applicable_indexes_broadcast_nothing(spark):
    """Columns that few bytes of input make are not held whole by every task, however small Spark takes them to be."""
    tables = spark.range(40).select(F.concat(F.lit("T"), "id").alias("table_name"), "id")
    columns = tables.select("table_name", F.explode(F.sequence(F.lit(0), F.col("id") % 4)).alias("o")).select(
        "table_name", F.concat(F.lit("c"), "o").alias("column_name"))
    indexes = tables.select("table_name", F.lit("ix").alias("index_name"), F.array(F.lit("c0"), F.lit("c2")).alias("columns"))
    out = layout.applicable_indexes(indexes, columns)
    assert {r["table_name"]: r["applicable"] for r in out.collect()} == {f"T{i}": i % 4 >= 2 for i in range(40)}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
