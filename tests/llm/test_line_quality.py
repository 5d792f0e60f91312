import itertools
import random
import re
from collections import Counter

import numpy as np
from edge import TEXTS, edge_docs, empty_docs, with_clashes

from ferrycraft.llm import line_quality as q

RNG = random.Random(5)
GOOD = "\n".join(" ".join("".join(RNG.choices("aeinrst", k=RNG.randint(2, 7))) for _ in range(9)) + "." for _ in range(12))
BAD = "\n".join(f"ITEM!! {i} | MENU## {i} | LOGIN$$ {i} | HOME%% {i} |" for i in range(12))


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts(spark):
    texts = [*TEXTS, GOOD, BAD, "a b c a b c", "x y\n\nx y\n \nx y", "\na\n", "a\x0bb\x0cc d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    out = {r["doc_id"]: r for r in q.judge(df, None).collect()}
    for i, text in enumerate(texts):
        assert tuple(out[i][c] for c in COLUMNS) == plain(text), text and text[:50]
        assert out[i]["kept"] == (not out[i]["base_failed"])


def test_many_distinct_words():
    """Pairs are renumbered when there are too many distinct words for one number."""
    ids = np.concatenate([np.arange(1 << 21) + 5, [5, 6, 7]])
    assert q.repeated_words(ids) == 6


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    field = q.Field(rng.normal(size=4), rng.normal(size=(2, 2)))
    ends = np.array([0, 3, 3, 8, 9])
    features = rng.normal(size=(9, 4))
    labels = q.viterbi(field, features, ends)
    for a, b in itertools.pairwise(ends.tolist()):
        def score(path):
            own = sum(features[a + t] @ field.weights for t, y in enumerate(path) if y)
            return own + sum(field.moves[x, y] for x, y in itertools.pairwise(path))
        best = max(itertools.product((0, 1), repeat=b - a), key=score)
        assert tuple(labels[a:b]) == best


def test_training_follows_the_gradient():
    """Marginals of the trained field meet the observed counts up to the penalty."""
    rng = np.random.default_rng(0)
    features = np.stack([np.ones(400), rng.normal(size=400)], axis=1)
    labels = (features[:, 1] + rng.normal(size=400) * 0.5 > 0).astype(np.int64)
    ends = np.arange(0, 401, 8)
    field = q.train(features, labels, ends)
    assert (q.viterbi(field, features, ends) == labels).mean() > 0.8
    assert field.weights[1] > 1


def test_field_tells_content(spark):
    docs = spark.createDataFrame(
        [(i, (GOOD if i % 2 else BAD).replace("a", f"a{i}").replace("MENU", f"MENU{i}")) for i in range(40)],
        "doc_id long, text string")
    labels = with_clashes(spark.createDataFrame(
        [(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int"))
    field = q.fit(docs, labels)
    out = {r["doc_id"]: r["kept"] for r in q.judge(docs, field).collect()}
    assert out == {i: i % 2 == 1 for i in range(40)}
    mixed = spark.createDataFrame([(1, GOOD + "\n" + BAD[:100])], "doc_id long, text string")
    row = q.judge(mixed, field, keep_text=True).first()
    assert row["kept"] and row["text"].startswith(GOOD) and len(row["content"]) == len(row["text"].split("\n"))


def test_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.fit(edge_docs(spark), labels) is None
    assert q.judge(edge_docs(spark), None).count() == len(TEXTS) + 2
    some = spark.createDataFrame([(i, i % 2) for i in range(14)], "doc_id long, quality int")
    field = q.fit(edge_docs(spark), some)
    assert q.judge(edge_docs(spark), field).count() == len(TEXTS) + 2
    assert q.judge(empty_docs(spark), field).count() == 0
