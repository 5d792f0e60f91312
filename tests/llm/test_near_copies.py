import random
import time
from pathlib import Path

import pytest
from edge import edge_docs, empty_docs

import corpus_pipeline
from ferrycraft import session
from ferrycraft.llm import near_copies as n

STAGES = dict(corpus_pipeline.STAGES)


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def plain_kept(rows):
    """Row numbers that stay, by all pairs."""
    sets = [plain_shingles(t) for _, t in rows]
    home = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if home[i] != home[j] and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                home = [home[j] if h == home[i] else h for h in home]
    return sorted(min((rows[i][0], i) for i in range(len(rows)) if home[i] == h)[1] for h in set(home))


def edited(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"x{rng.randrange(10 ** 6)}"
    return words


def made(seed, heads=30, copies=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(heads):
        head = [f"w{rng.randrange(3000)}" for _ in range(200)]
        rows += [(len(rows), " ".join(head))]
        rows += [(len(rows) + i, " ".join(edited(rng, head, rng.choice([0, 1, 2, 4, 8])))) for i in range(rng.randrange(copies))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sample, bands", [(n.SAMPLE, n.BANDS), (10, n.BANDS), (n.SAMPLE, 0)])
def test_near_copies_go(spark, monkeypatch, sample, bands):
    """Whatever the order was learned from, and with nothing joined by the quick search, no pair is lost."""
    monkeypatch.setattr(n, "SAMPLE", sample)
    if not bands:
        monkeypatch.setattr(n, "leader_pairs", lambda marked: marked.select("id", "id").toDF("a", "b").limit(0))
    rows = made(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {tuple(r) for r in STAGES["simhash_near_dedup"](spark, df, "").collect()}
    assert out == {rows[i] for i in plain_kept(rows)}
    assert len(out) < len(rows) / 2


def templated(seed, pairs, shared=440, own=62, changed=4):
    """Pairs of near copies that all share a template: 0.83 within a pair, 0.78 to all others."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(shared)]
    rows = []
    for _ in range(pairs):
        body = [f"w{rng.randrange(10 ** 9)}" for _ in range(own)]
        twin = body[:-changed * 10] + [f"v{rng.randrange(10 ** 9)}" for _ in range(changed * 10)]
        rows += [(len(rows), " ".join(template + body)), (len(rows) + 1, " ".join(template + twin))]
    return rows


def test_pairs_that_share_a_template(spark):
    rows = templated(2, 400)
    a, b, c = (plain_shingles(rows[i][1]) for i in range(3))
    assert len(a & b) / len(a | b) >= 0.8 > len(a & c) / len(a | c) > 0.77
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    named = n._named(df)
    marked = n.stage(n.signatures(named, n.common_shingles(named)).withColumn("id", n.F.monotonically_increasing_id()))
    meet = n.apart_pairs(marked, spark.createDataFrame([], "node long, component long"))
    assert meet.count() < 3 * len(rows)  # the template's shingles come last, so pages of it don't meet by it
    out = [r["doc_id"] for r in STAGES["simhash_near_dedup"](spark, df, "").collect()]
    assert sorted(out) == list(range(0, len(rows), 2))


def test_large_groups_are_not_compared_with_themselves(spark):
    rng = random.Random(3)
    head = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, head, 1))) for i in range(3000)] + [(9000, "not one of them at all"), (9001, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    named = n._named(df)
    marked = n.stage(n.signatures(named, n.common_shingles(named)).withColumn("id", n.F.monotonically_increasing_id()))
    pairs = n.leader_pairs(marked)
    assert pairs.count() <= n.BANDS * len(rows)
    found = n.components(n.verified(named, marked, pairs))
    assert n.apart_pairs(marked, found).count() < len(rows)
    assert sorted(r["doc_id"] for r in STAGES["simhash_near_dedup"](spark, df, "").collect()) == [0, 9000, 9001]


def test_similarity():
    a, b = "a b c d e f g h", "A  b c d e f g\tx"
    x, y = plain_shingles(a), plain_shingles(b)
    assert n.similar(n.shingles(a.encode()), n.shingles(b.encode())) == (len(x & y) >= 0.8 * len(x | y))
    five = " ".join("abcdefghi")
    assert n.similar(n.shingles(five.encode()), n.shingles((five + " z").encode()))  # 5 of 6
    assert not n.similar(n.shingles(five.encode()), n.shingles((five + " y z").encode()))  # 5 of 7
    assert n.similar(n.shingles(b" \n"), n.shingles(b""))
    assert not n.similar(n.shingles(b"one two"), n.shingles(b"two one"))


def test_edges(spark):
    docs = edge_docs(spark)
    out = STAGES["simhash_near_dedup"](spark, docs, "")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted(rows[i][0] for i in plain_kept(rows))
    assert out.where("doc_id IS NULL").count() == 1 and out.columns == docs.columns
    assert STAGES["simhash_near_dedup"](spark, empty_docs(spark), "").count() == 0


def test_rows_that_share_a_doc_id(spark):
    """Each row is judged by its own text: no unrelated row goes with a copy, no group goes whole."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, c), (3, a), (3, c + " more"), (7, a + " end"), (7, b), (7, b), (8, a)]
    out = STAGES["simhash_near_dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(tuple, out.collect())) == [(1, c), (3, a), (7, b)]
    many = spark.createDataFrame([(5, f"{i} " + " ".join(f"{i}x{j}" for j in range(20))) for i in range(40)], "doc_id long, text string")
    assert STAGES["simhash_near_dedup"](spark, many, "").count() == 40


def test_simhash_finds_near_copies(spark, monkeypatch):
    """The SimHash search alone brings texts together, and is a part of the stage."""
    rng = random.Random(4)
    head = [f"w{i}" for i in range(900)]
    texts = [" ".join(edited(rng, head, 1)) for _ in range(40)] + [" ".join(f"o{i}x{j}" for j in range(90)) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    named = n._named(df)
    marked = n.stage(n.signatures(named, n.common_shingles(named)).withColumn("id", n.F.monotonically_increasing_id()))
    own = n.shingles(texts[0].encode())
    bits = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in own) > len(own))
    assert int(n.simhash(own)) % (1 << 64) == bits
    found = n.components(n.verified(named, marked, n.simhash_pairs(marked)))
    assert 20 < found.count() <= 40 and found.select("component").distinct().count() <= 4
    called = []
    monkeypatch.setattr(n, "simhash_pairs", lambda marked, own=n.simhash_pairs: called.append(1) or own(marked))
    assert STAGES["simhash_near_dedup"](spark, df, "").count() == 41 and called


def test_pairs_that_share_much_are_told_once_or_so(spark, monkeypatch):
    """Texts of a similarity of just under 0.8 share many first shingles; rows of pairs follow the pairs, not the shingles."""
    rng = random.Random(5)
    head = [f"w{i}" for i in range(2000)]
    texts = [" ".join(head[:at] + [f"x{i}y{j}" for j in range(200)] + head[at + 200:]) for i, at in enumerate((0, 400, 900, 1500))]
    told = []

    def meetings(rows, own=n._meetings):
        told.append(n.stage(own(rows)))
        return told[-1]

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named = n._named(df)
    marked = n.stage(n.signatures(named, n.common_shingles(named)).withColumn("id", n.F.monotonically_increasing_id()))
    monkeypatch.setattr(n, "_meetings", meetings)
    n.apart_pairs(marked, spark.createDataFrame([], "node long, component long"))
    pairs = told[-1].distinct().count()
    assert pairs and told[-1].count() <= 3 * pairs


def marked_of(spark, texts):
    named = n._named(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    return named, n.stage(n.signatures(named, n.common_shingles(named)).withColumn("id", n.F.monotonically_increasing_id()))


def test_tables_and_shuffle_files_go_with_their_step(spark):
    rows = made(6, heads=8)
    shared = Path(session.shared_dir(spark).removeprefix("file:"))
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {str(f): f.stat().st_size for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    old, files = set(shared.iterdir()), shuffled()
    n.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert [p.name.split("-")[0] for p in set(shared.iterdir()) - old] == ["near_copies"]
    wide = session.settle(spark, lambda: spark.range(400_000).repartition(4).select((n.F.rand(1) * 1e18).cast("long").alias("x")), "wide")
    assert wide.count() == 400_000
    for _ in range(40):
        left = sum(size for f, size in shuffled().items() if f not in files)
        if left < 1_000_000:
            break
        time.sleep(0.25)
    assert left < 1_000_000


def test_unrelated_texts_of_frequent_words_hardly_meet(spark, monkeypatch):
    """Five frequent words in a row are in many texts by chance: such shingles come late though no sample tells them."""
    monkeypatch.setattr(n, "SAMPLE", 10)
    rng = random.Random(7)
    texts = [" ".join(f"f{rng.randrange(8)}" if rng.random() < 0.7 else f"w{rng.randrange(10 ** 9)}" for _ in range(600)) for _ in range(300)]
    _, marked = marked_of(spark, texts)
    assert n.apart_pairs(marked, spark.createDataFrame([], "node long, component long")).count() < 10


def test_only_texts_of_likely_pairs_are_shuffled(spark, monkeypatch):
    rng = random.Random(8)
    head = [f"w{i}" for i in range(900)]
    texts = [" ".join(head), " ".join(edited(rng, head, 2))] + [" ".join(head[:450] + [f"o{i}x{j}" for j in range(450)]) for i in range(10)]
    named, marked = marked_of(spark, texts)
    ids = sorted(r["id"] for r in marked.collect())
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a > b], "a long, b long")
    staged = []

    def kept(df, label="stage", own=n.stage):
        staged.append((label, own(df, label)))
        return staged[-1][1]

    monkeypatch.setattr(n, "stage", kept)
    assert n.verified(named, marked, pairs).count() == 1
    assert [df.count() for label, df in staged if label == "texts"] == [2]


def test_wide_sketches_never_part_similar_texts():
    rng = random.Random(9)
    for size in (1, 40, 63, 64, 700, 3000):
        for _ in range(40):
            words = [f"w{rng.randrange(10 ** 6)}" for _ in range(size + 4)]
            a = n.shingles(" ".join(words).encode())
            b = n.shingles(" ".join(edited(rng, words, rng.randrange(1 + len(words) // 30)) + words[:rng.randrange(3)]).encode())
            assert n.may_be_similar(len(a), n.wide_sketch(a), len(b), n.wide_sketch(b)) or not n.similar(a, b)
    other = n.shingles(" ".join(f"o{i}" for i in range(3000)).encode())
    assert not n.may_be_similar(len(a), n.wide_sketch(a), len(other), n.wide_sketch(other))


def test_shingles_that_meet_in_parts(spark, monkeypatch):
    monkeypatch.setattr(n, "MANY", 0)
    monkeypatch.setattr(n, "leader_pairs", lambda marked: marked.select("id", "id").toDF("a", "b").limit(0))
    rows, parts = made(10, heads=10), set()
    monkeypatch.setattr(n, "_first_rows", lambda *given, own=n._first_rows: parts.add(given[2:]) or own(*given))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in STAGES["simhash_near_dedup"](spark, df, "").collect()} == {rows[i] for i in plain_kept(rows)}
    assert len(parts) > 1
