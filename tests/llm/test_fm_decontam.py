import random
import re

import numpy as np
import pytest
from edge import TEXTS, edge_docs, empty_docs, with_clashes

from ferrycraft.llm import fm_decontam as f

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(text, items, width):
    own, hit, held = words(text), set(), set()
    for name, passage in items:
        w = words(passage)
        windows = [w[i:i + width] for i in range(max(1, len(w) - width + 1))] if w else []
        for window in windows:
            for at in range(len(own) - len(window) + 1):
                if own[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    held.add("" if name is None else str(name))
    return len(own), len(hit), sorted(held)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("most", [1 << 22, 20])
def test_against_all_windows(spark, seed, most):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "De", "É", "x1", "日本"][:3 + seed]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 6, 9]))) for i in range(5)] + [(9, None), (None, text(5)), (2, text(7))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(40, None)]
    found = f.find_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(2),
                            with_clashes(spark.createDataFrame(items, "item_id long, text string")), width=4, block_words=most)
    out = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.collect()}
    assert out == {i: plain(t, items, 4) for i, t in docs}


def test_spans(spark):
    docs = spark.createDataFrame([(1, "É x. ONE two,\nthree four five — y")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four"), (2, "two three four FIVE")], "item_id long, text string")
    row = f.find_passages(docs, items, width=4, keep_text=True).first()
    assert [row["text"][s["start"]:s["end"]] for s in row["spans"]] == ["ONE two,\nthree four five"]
    assert (row["n_words"], row["n_hit"], row["items"]) == (9, 5, ["1", "2"])  # the dash is a word


def test_index_counts_and_locates():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 500)
    text[[99, 300, 499]] = 0
    index = f.FMIndex(text, 200, 5)
    windows = np.array([[1, 2, 0], [3, 3, 3], [2, 0, 0], [5, 1, 0], [1, 1, 4]])
    lengths = np.array([2, 3, 1, 2, 3])
    found, first, last = index.search(windows, lengths)
    got = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(found, first, last)}
    want = {}
    for w, (row, n) in enumerate(zip(windows, lengths)):
        at = [i for i in range(500 - n + 1) if (text[i:i + n] == row[:n]).all()]
        if at:
            want[w] = at
    assert got == want


def test_edges(spark):
    items = spark.createDataFrame([(1, "the same text in two rows long enough to be more")], "item_id long, text string")
    out = f.find_passages(edge_docs(spark), items).collect()
    assert len(out) == len(TEXTS) + 2 and sum(r["n_hit"] > 0 for r in out) == 2
    assert f.find_passages(edge_docs(spark), items.limit(0)).where("n_hit > 0").count() == 0
    assert f.find_passages(empty_docs(spark), items).count() == 0
