import datetime
import random

import pytest
from edge import with_clashes
from pyspark.sql import functions as F

from ferrycraft.llm import url_lists as u

DAY = datetime.date(2023, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


@pytest.mark.parametrize("url,key,host,domains", [
    ("HTTP://User@WWW.Example.COM:80/A?b#c", "http://user@www.example.com:80/A?b", "www.example.com",
     ["www.example.com", "example.com"]),
    ("https://a.b.example.org./", "https://a.b.example.org./", "a.b.example.org",
     ["a.b.example.org", "b.example.org", "example.org"]),
    ("http://localhost", "http://localhost", "localhost", ["localhost"]), ("", "", "", [""]), ("no url", "no url", "", [""]),
    ("x://h/p\nq#f\ng", "x://h/p\nq", "h", ["h"])])
def test_keys(spark, url, key, host, domains):
    c = F.col("url")
    row = spark.createDataFrame([(url,)], "url string").select(
        u.url_key(c), u.host_of(c), u.parents(u.host_of(c))).first()
    assert tuple(row) == (key, host, domains)


def plain(captures, entries):
    out = []
    for key, url, when in captures:
        lists = []
        if url is not None and when is not None:
            host = url.split("//")[1].split("/")[0].lower()
            labels = host.split(".")
            names = {("url", url), ("host", host)} | {
                ("domain", ".".join(labels[i:])) for i in range(max(1, len(labels) - 1))}
            groups = {}
            for name, kind, k, dated, blocks in entries:
                if None not in (name, kind, k, dated, blocks) and (kind, k) in names and dated <= when:
                    groups.setdefault((name, kind, k), []).append((dated, blocks))
            lists = [g[0] for g, rows in groups.items() if max(rows)[1]]
        out.append((key, bool(lists), len(lists), ",".join(sorted(set(lists)))))
    return sorted(out, key=repr)


ENTRY = "list string, kind string, key string, dated date, blocks boolean"


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("period", ["year", "month"])
def test_against_every_entry(spark, seed, period):
    rng = random.Random(seed)
    hosts = ["a.x.com", "b.x.com", "x.com", "y.org", "c.d.y.org"]
    urls = [f"http://{h}/{p}" for h in hosts for p in "pq"]
    captures = [(i, rng.choice(urls), day(rng.randint(0, 900))) for i in range(150)]
    captures += [(7, captures[0][1], captures[0][2]), captures[1], (None, urls[0], day(5)), (200, None, day(1)), (201, urls[1], None)]
    keys = [("url", k) for k in urls] + [("host", k) for k in hosts] + [("domain", k) for k in ("x.com", "y.org", "d.y.org", "com")]
    entries = [(rng.choice("LMN"), *rng.choice(keys), day(rng.randint(-100, 1100)), rng.random() < 0.6) for _ in range(200)]
    entries += entries[:20] + [(e[0], e[1], e[2], e[3], not e[4]) for e in entries[:20]] + [(None, "host", "x.com", day(0), True), ("L", "host", "x.com", None, True)]
    got = u.filter_urls(spark.createDataFrame(captures, "id long, url string, fetched_at date").repartition(3),
                        with_clashes(spark.createDataFrame(entries, ENTRY).withColumnRenamed("key", "k")).drop("key").withColumnRenamed("k", "key"),
                        period=period)
    assert sorted((tuple(r) for r in got.select("id", "blocked", "n_active", "lists").collect()), key=repr) == plain(captures, entries)


def test_edges(spark):
    captures = spark.createDataFrame([(1, "http://x.com/", day(3), True)], "id long, url string, fetched_at date, blocked boolean")
    entries = spark.createDataFrame([("L", "domain", "x.com", day(3), True)], ENTRY)
    wide = captures.select("*", F.lit("k").alias("key"), F.lit(1).alias("address"), F.lit(2).alias("host"), F.lit(3).alias("day"), F.lit(4).alias("__x"))
    row = u.filter_urls(wide, entries).first()
    assert (row["key"], row["address"], row["host"], row["day"], row["__x"], row["n_active"], row["blocked"]) == ("k", 1, 2, 3, 4, 1, True)
    assert u.filter_urls(captures, entries).first()["n_active"] == 1
    assert u.filter_urls(captures, entries.limit(0)).first()["blocked"] is False
    assert u.filter_urls(captures.limit(0), entries).count() == 0
    assert u.filter_urls(captures.withColumn("url", F.lit(None).cast("string")), entries).first()["blocked"] is False
