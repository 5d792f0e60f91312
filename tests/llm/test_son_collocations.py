import random
import re
from collections import Counter, defaultdict

import pytest
from edge import edge_docs, empty_docs, rows

from ferrycraft.llm import queries, son_collocations as c

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, support=10, longest=3, most=2000):
    found = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall("[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                found["und" if lang is None else lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in found.items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        frequent = {p: n for p, n in f.items() if len(p) > 1 and n >= support}
        ranked = []
        for p, a in frequent.items():
            holders = [n for q, n in frequent.items() if len(q) > len(p)
                       and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if holders and 100 * max(holders) >= 50 * a:
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, total, -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:most], 1)]
    return sorted(out, key=repr)


def made(seed, n=120):
    rng = random.Random(seed)
    words = [rng.choice(["a", "b", "c", "dd", "É", "é", " x", "x\x1cy", "日本"]) + rng.choice(["", "q", "r"]) for _ in range(12)]
    return [(rng.choice(["en", "en", "de", None, "und"]), rng.choice(["", "New York City "]) + "".join(
        rng.choice(words).upper() * rng.choice([0, 1]) + rng.choice(words) + rng.choice([" ", " ", "\t ", ", ", "\n", "."])
        for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize("shards, support, longest, most", [(4, 10, 3, 2000), (9, 3, 4, 7), (1, 10, 2, 50)])
def test_phrases(spark, shards, support, longest, most):
    docs = made(shards)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    out = c.collocations(df, support, longest, most, shards=shards)
    assert rows(out, "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain(docs, support, longest, most)


def test_false_hits_change_nothing(spark, monkeypatch):
    """Bitmaps so full that they let nearly all through."""
    docs = made(8)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    monkeypatch.setattr(c.Bitmap, "has", lambda self, hashes: hashes == hashes)
    monkeypatch.setattr(c, "KNOWN", 3)
    monkeypatch.setattr(c, "COUNTED", 10)
    monkeypatch.setattr(c, "HASHES", 10)
    assert rows(c.collocations(df), "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain(docs)


def test_bitmap(spark):
    rng = random.Random(3)
    held = [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(5000)] + [0, -1, 2 ** 63 - 1, -2 ** 63, 2 ** 15 - 1, 2 ** 15]
    marks = c.bitmap(spark.createDataFrame([(h,) for h in held], "h long"), len(held))
    import numpy as np
    assert marks.has(np.array(held).view(np.uint64)).all()
    assert marks.has(np.random.default_rng(1).integers(0, 2 ** 63, 10000, dtype=np.uint64)).mean() < 0.1
    assert not c.bitmap(spark.createDataFrame([], "h long"), 0).has(np.arange(9, dtype=np.uint64)).any()


def test_scores_pass_64_bits(spark, monkeypatch):
    """Numbers as large as a corpus of 100 TB has."""
    words = spark.createDataFrame([("en", "a", 9 * 10 ** 12), ("en", "b", 8 * 10 ** 12)], "lang string, phrase string, n long")
    phrases = spark.createDataFrame([("en", "a b", 7 * 10 ** 12)], "lang string, phrase string, n long")
    monkeypatch.setattr(c, "phrase_counts", lambda *a: (words, phrases))
    (row,) = c.collocations(words).collect()
    assert row["score"] == 10 ** 6 * 49 * 10 ** 24 // (72 * 10 ** 24) and row["n"] == 17 * 10 ** 12


def test_query(spark):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op13_son_collocations"](spark, SF)
    assert rows(out, "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain(docs)


def test_edges(spark):
    docs = edge_docs(spark)
    from pyspark.sql import functions as F
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en")).withColumn("own", F.lit(1))
    plain_docs = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert rows(c.collocations(docs), "lang", "rank", "phrase", "a", "l", "r", "n", "score") == plain(plain_docs)
    assert c.collocations(empty_docs(spark).withColumn("lang", F.lit("en"))).collect() == []
