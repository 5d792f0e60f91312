import random
import zlib

import numpy as np
import pytest
from edge import TEXTS, edge_docs, empty_docs, with_clashes

from ferrycraft.llm import quality_qda as q


def test_densities_equal_the_formula():
    rng = np.random.default_rng(0)
    rows = [rng.normal(size=(60, 3)), rng.normal(size=(40, 3)) @ np.diag([1, 2, 3]) + 1]
    model = q.discriminant(np.array([60.0, 40.0]), np.stack([r.sum(axis=0) for r in rows]),
                           np.stack([r.T @ r for r in rows]), shrinkage=0.2)
    every = np.concatenate(rows)
    spread = [np.cov(r.T, bias=True) for r in rows]
    scale = np.sqrt((60 * np.diag(spread[0]) + 40 * np.diag(spread[1])) / 100)
    logs = []
    for r, s, share in zip(rows, spread, (0.6, 0.4)):
        scaled = s / np.outer(scale, scale)
        own = 0.8 * scaled + 0.2 * np.trace(scaled) / 3 * np.eye(3)
        own *= np.outer(scale, scale)
        away = every - r.mean(axis=0)
        logs.append(np.log(share) - 0.5 * np.linalg.slogdet(own)[1]
                    - 0.5 * np.einsum("ni,ij,nj->n", away, np.linalg.inv(own), away))
    assert np.allclose(model.difference(every), logs[1] - logs[0])
    assert np.allclose(model.score(every), 1 / (1 + np.exp(logs[0] - logs[1])))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)

    def word():
        return "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 8)))

    def good(n):
        return "\n".join(" ".join(word() for _ in range(8)).capitalize() + "." for _ in range(n))

    def bad(n):
        kind = rng.randrange(3)
        return " ".join(word() + "###" if kind == 0 else word().upper() + "!!" if kind == 1 else "same" for _ in range(8 * n))

    texts = [(good if i % 4 else bad)(rng.randint(2, 9)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    out = q.score_quality(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 40 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert sum(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_learned_from(spark, corpus):
    docs, labels = corpus
    turned = labels.withColumn("quality", (1 - labels["quality"]) * q.held_out(labels["doc_id"]).cast("int")
                               + labels["quality"] * (~q.held_out(labels["doc_id"])).cast("int"))
    one = {r["doc_id"]: r["score"] for r in q.score_quality(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in q.score_quality(docs, turned).collect()}
    assert all(abs(one[i] - two[i]) < 1e-9 for i in one)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = q.score_quality(edge_docs(spark), none).collect()
    assert len(out) == len(TEXTS) + 2 and {r["score"] for r in out} == {0.5}
    one = with_clashes(spark.createDataFrame([(i, 1) for i in range(14)] + [(None, 0), (1, None), (2, 7)], "doc_id long, quality int"))
    assert {r["score"] for r in q.score_quality(edge_docs(spark), one).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(14)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in q.score_quality(edge_docs(spark), both).collect())
    assert q.score_quality(empty_docs(spark), both).count() == 0
