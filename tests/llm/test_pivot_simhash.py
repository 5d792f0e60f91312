import random
import re

import numpy as np
import pytest
import xxhash
from edge import TEXTS, edge_docs, empty_docs
from pyspark.sql import functions as F

from ferrycraft.llm import components as c
from ferrycraft.llm import pivot_simhash as p


def plain_print(text, width=3):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Least key reachable, by all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two Words", "a b c d", "É é È x y", "the " * 70000])
def test_fingerprint(text):
    if text and len(text) > 1000:  # all shingles but the first are alike
        assert p.fingerprint(text.encode(), 3) == xxhash.xxh64_intdigest(b"the the the", 42)
    else:
        assert p.fingerprint((text or "").encode(), 3) == plain_print(text)


def clustered(n, seed):
    rng = random.Random(seed)
    heads = [rng.getrandbits(64) for _ in range(n // 10)]
    prints = {}
    for key in range(n):
        own = rng.choice(heads)
        for bit in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5])):
            own ^= 1 << bit
        prints[key] = own
    return prints


@pytest.mark.parametrize("options", [{}, {"groups": 4}, {"cell_limit": 0}, {"cell_limit": 3}, {"radius": 3}])
def test_links_connect_what_all_pairs_connect(spark, options):
    prints = clustered(400, len(options))
    nodes = {}
    for key, own in prints.items():
        nodes.setdefault(own, key)
    df = spark.createDataFrame([(int(np.uint64(o).view(np.int64)), k) for o, k in nodes.items()], "print long, node long")
    found = {r["node"]: r["component"] for r in c.components(p.links(df.repartition(3), **options)).collect()}
    want = plain_components({k: o for o, k in nodes.items()}, options.get("radius", 2))
    assert {k: found.get(k, k) for k in want} == want


def test_pivots_discard_no_true_pair():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = np.concatenate([prints, prints ^ np.uint64(5), prints ^ np.uint64(1 << 60)])
    pairs = {tuple(sorted(x)) for a, b in p.close_pairs(np.zeros(len(prints)), prints, 2, p.references())
             for x in zip(a.tolist(), b.tolist())}
    assert pairs == {(i, j) for j in range(len(prints)) for i in range(j)
                     if int(prints[i] ^ prints[j]).bit_count() <= 2}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (9, 9)]
    rng.shuffle(edges)
    out = {r["node"]: r["component"] for r in c.components(spark.createDataFrame(edges * 2, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(50)}
    assert c.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_and_edges(spark):
    docs = edge_docs(spark)
    out = p.simhash_components(docs).collect()
    assert len(out) == len(TEXTS) + 2
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    prints = {k: plain_print(t) if not t or len(t) < 10000 else None for k, t in texts.items()}
    for r in out:
        if prints.get(r["doc_id"]) is not None:
            assert np.int64(r["print"]).view(np.uint64) == prints[r["doc_id"]]
    own = {k: int(np.int64(r["print"]).view(np.uint64)) for r in out if (k := r["doc_id"]) is not None}
    assert {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None} == plain_components(own, 2)
    assert p.simhash_components(empty_docs(spark)).count() == 0
    assert p.simhash_components(docs.withColumn("text", F.lit("same"))).select("component_id").distinct().count() == 1
