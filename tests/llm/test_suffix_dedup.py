import random
from collections import Counter
from unittest import mock

import numpy as np
import pytest
from edge import TEXTS, edge_docs, empty_docs

from ferrycraft.llm import suffix_dedup as d


def plain(texts, span):
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if count[t[i:i + span]] > 1:
                gone[i:i + span] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((len(t), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdef ") for _ in range(200)) for _ in range(5)]
    out = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                part = rng.choice(base)[rng.randint(0, 150):][:rng.randint(10, 120)]
                if rng.random() < 0.5 and part:
                    at = rng.randrange(len(part))
                    part = part[:at] + "Z" + part[at + 1:]
            elif kind < 0.7:
                part = rng.choice(["a", "xyé"]) * rng.randint(1, 60)
            else:
                part = "".join(rng.choice("ghijklm") for _ in range(rng.randint(1, 60)))
            parts.append(part)
        out.append("".join(parts))
    return out


def found(spark, given, **options):
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(3)
    out = sorted(d.remove_repeats(df, span=40, **options).collect(), key=lambda r: r["doc_id"])
    return [(r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in out]


@pytest.mark.parametrize("options", [{"gram": 8}, {"gram": 24}, {"gram": 8, "hot": 1}, {"gram": 40}])
def test_against_all_strings(spark, options):
    given = [*texts(1), None, ""]
    assert found(spark, given, **options) == plain(given, 40)


def test_collisions_remove_nothing(spark):
    """With hashes that are all equal the byte check sends every bucket to the plain sort."""
    parts = [b"0123456789" * 8, b"0123456789" * 7 + b"x123456789", b"9123456789" + b"0123456789" * 7]
    offs, group = np.array([20, 20, 20]), np.zeros(3, np.int64)
    right = d.repeated_windows(parts, offs, group, 40)
    with mock.patch.object(d.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64)):
        assert d.repeated_windows(parts, offs, group, 40) == right
    assert right[0] and right[1] and right[2]


def test_suffix_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts = np.sort(rng.choice(500, 90, replace=False))
    group = np.repeat([3, 5, 9], [1, 40, 49])
    ends = np.minimum(starts + 60, 600)
    order, shared = d.suffix_sort(data, starts, ends, group)
    parts = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert [(group[i], parts[i]) for i in order] == sorted((g, p) for g, p in zip(group, parts))
    plain_order, plain_shared = d._plain_sort(data, starts, ends, group)
    assert shared.tolist() == plain_shared.tolist()


def test_edges(spark):
    out = d.remove_repeats(edge_docs(spark)).collect()
    assert len(out) == len(TEXTS) + 2
    texts_ = [r["text"] for r in edge_docs(spark).collect()]
    want = sorted((n, runs, kept) for n, runs, kept in plain([t for t in texts_ if t is None or len(t) < 10000], 400))
    assert sorted((r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in out if r["n_bytes"] < 10000) == want
    assert all(len(r["kept"]) == 0 for r in out if r["n_bytes"] > 100000)  # copies of one another
    assert d.remove_repeats(empty_docs(spark)).count() == 0
