import random
import zlib

import pytest
from edge import TEXTS, edge_docs, empty_docs

from ferrycraft.llm import shard_packing as s


def naive_best_fit(sizes, capacity):
    rooms, placed = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            room, i = min(fits)
        else:
            i = len(rooms)
            rooms.append(max(capacity, size))
        rooms[i] -= size
        placed.append(i)
    return placed


@pytest.mark.parametrize("seed", range(5))
def test_tree_picks_the_tightest_bin(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 120) for _ in range(300)), reverse=True)
    assert s.best_fit_decreasing(sizes, 100) == naive_best_fit(sizes, 100)
    assert s.best_fit_decreasing(sizes, 100, 10) is None


@pytest.mark.parametrize("seed", range(4))
def test_sizes_are_near_equal(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 1000) for _ in range(2000)), reverse=True)
    totals = [0] * 16
    for size, shard in zip(sizes, s.pack(sizes, 16), strict=True):
        totals[shard] += size
    assert max(totals) - min(totals) < 0.02 * sum(totals) / 16


def test_few_and_huge_units():
    assert s.pack([], 4) == []
    assert sorted(s.pack([9, 1], 4)) == [0, 1]
    placed = s.pack([1000, 10, 10, 10, 10, 10, 10], 3)
    assert placed.count(0) == 1 and placed.count(1) == placed.count(2) == 3


def packed(spark, rows, shards=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return s.pack_shards(df, shards=shards).collect()


def test_laws(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    rows = [(i, rng.choice(texts)) for i in range(1000)]
    out = packed(spark, rows)
    text = dict(rows)
    assert sorted(r["doc_id"] for r in out) == sorted(text)
    shards, homes = {}, {}
    for r in out:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        shards.setdefault(r["shard"], []).append(r)
        homes.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert set(shards) == {0, 1, 2, 3} and all(len(h) == 1 for h in homes.values())
    totals = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(totals) < 1.02 * min(totals)
    for own in shards.values():
        own.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert [r["doc_id"] for r in own] == sorted(r["doc_id"] for r in own)


def test_a_group_over_a_shard_is_split(spark):
    rows = [(i, "copy " * 50) for i in range(600)] + [(i, f"text {i} " * 20) for i in range(600, 1000)]
    totals = {}
    for r in packed(spark, rows):
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    assert max(totals.values()) < 1.1 * min(totals.values())


def test_edges(spark):
    out = s.pack_shards(edge_docs(spark), shards=5).collect()
    assert len(out) == len(TEXTS) + 2 and {r["size"] for r in out if r["doc_id"] in (0, 1)} == {16}
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    assert s.pack_shards(empty_docs(spark)).count() == 0
