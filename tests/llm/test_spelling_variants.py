import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from edge import edge_docs, empty_docs, rows

from ferrycraft.llm import queries, spelling_variants as s

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(a, b):
    """By the rows of the edit distance table."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def plain_variants(words):
    near = {a: [b for b in words if plain_near(a, b)] for a in words}
    form = {a: min(l, key=lambda b: (-words[b], b)) for a, l in near.items() if l}
    form = {a: b for a, b in form.items() if words[b] >= 10 * words[a]}

    def root(a):
        while a in form:
            a = form[a]
        return a

    return sorted(((a, form.get(a), root(a), words[a], len(near[a]), words.get(form.get(a))) for a in words), key=repr)


def made(seed, alphabet, count, length):
    """Words close to each other, of very different numbers."""
    rng, words = random.Random(seed), {}
    while len(words) < count:
        word = [rng.choice(alphabet) for _ in range(rng.choice(length))]
        for _ in range(rng.randrange(6)):
            words["".join(word)] = rng.choice([2, 3, 20, 200, 2000, 20000])
            at = rng.randrange(len(word))
            kind = rng.randrange(3)
            word[at:at + (kind > 0)] = [] if kind == 1 else [rng.choice(alphabet)]
            word = word or ["a"]
    return {w: n for w, n in words.items() if w}


@pytest.mark.parametrize("limit", [s.CELL_LIMIT, 3])
@pytest.mark.parametrize("often", [1, s.OFTEN])
def test_words_close_to_each_other(spark, limit, often):
    words = made(5, "abé", 300, [1, 2, 3, 6, 7, 8, 9, 12, 31, 32, 33, 34, 60])
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows(s.spelling_variants(df, often=often, cell_limit=limit), "*") == plain_variants(words)


def test_one_edit():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(2))
        assert s.one_edit(a, b) == plain_near(a, b)


@pytest.mark.parametrize("often", [0, 2, 1000])
def test_bounds_of_affected_grams(often):
    """After any one edit a word shares a list with the edited one and lacks no more of its grams than the bound says."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    counts = Counter(w[i:i + n] for w in words for n in (2, 3) for i in range(len(w) - n + 1))
    frequent = {g: n for g, n in counts.items() if n > often}
    for a in words:
        at = rng.randrange(len(a) + 1)
        b = rng.choice([a[:at] + "x" + a[at:], a[:at] + "a" + a[at + 1:], a[:at] + a[at + 1:], a + rng.choice("abc")])
        if not plain_near(a, b) or not b:
            continue
        (one, sign, most), (other, sign_b, most_b) = s.entries(a, frequent), s.entries(b, frequent)
        assert set(one) & set(other), (a, b)
        assert (sign & ~sign_b).bit_count() <= most and (sign_b & ~sign).bit_count() <= most_b


def test_dictionary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(s, "FREQUENT", 50)
    words = made(6, "abcdef", 200, [7, 8, 9])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    dictionary, often = s.gram_dictionary(df, 1)
    assert often > 1 and dictionary.count() <= 50
    monkeypatch.setattr(s.near_words, "__defaults__", (1, s.CELL_LIMIT))
    assert rows(s.spelling_variants(df), "*") == plain_variants(words)


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    words = plain_words(docs)
    out = queries.QUERIES["op11_gram_variants"](spark, SF)
    near = defaultdict(set)
    for w in words:
        for cut in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            near[cut].add(w)
    want = {}
    for w in words:
        others = {v for cut in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in near[cut] if plain_near(w, v)}
        best = min(others, key=lambda b: (-words[b], b), default=None)
        want[w] = (best if others and words[best] >= 10 * words[w] else None, len(others))
    got = {r["word"]: r for r in out.collect()}
    assert {w: (r["form"], r["n_near"]) for w, r in got.items()} == want
    assert {w: r["n"] for w, r in got.items()} == words
    for w, r in got.items():
        end = w
        while want[end][0]:
            end = want[end][0]
        assert r["root"] == end and r["form_n"] == words.get(r["form"])


def test_edges(spark):
    """NULL, empty and long texts, repeated rows, NULL keys, clashing columns, empty tables."""
    docs = edge_docs(spark, [None, "", "Words letters lettters LETTERS. " * 3000, "lettter lettters Übermut ÜBERMUT übermut"])
    plain = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    counted = s.count_words(docs)
    assert dict(map(tuple, counted.collect())) == plain_words(plain)
    assert rows(s.spelling_variants(counted), "*") == plain_variants(plain_words(plain))
    assert s.spelling_variants(s.count_words(empty_docs(spark))).collect() == []
    odd = spark.createDataFrame([(None, 4), ("", 5), ("abcdefg", 2), ("abcdefg", 3), ("abcdefgh", 1)], "word string, n long")
    assert rows(s.spelling_variants(odd), "word", "n", "n_near") == [("abcdefg", 5, 1), ("abcdefgh", 1, 1)]


def test_chains_of_forms(spark):
    chain = [("aaaaaaa" + "b" * i, 10 ** i) for i in range(9)]
    df = spark.createDataFrame(chain, "word string, n long")
    assert {r["root"] for r in s.spelling_variants(df).collect()} == {chain[-1][0]}
