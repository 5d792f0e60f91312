"""URL filters: captures against the list entries that were active when they were fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("url", "host", "domain")
#: Intervals and captures meet in periods of this length, so one key's history is not compared as a whole.
PERIOD = "year"


def url_key(url: Column) -> Column:
    """The URL without its fragment, scheme and authority in lower case."""
    head = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)
    return F.concat(F.lower(head), F.regexp_replace(url.substr(F.length(head) + 1, F.length(url)), "(?s)#.*$", ""))


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and final dot; empty when the URL has none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def parents(host: Column) -> Column:
    """The host and the domains above it that have two labels or more."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, kind, key, since, until)``: when a list blocks a key, ``until`` (exclusive) NULL if it still does.

    An entry holds from its date to the next one of the same list and key; of several on one date a blocking one
    counts. These are merged first, so the window of a key sees one row a day at most however many entries repeat.
    Entries with a NULL in any column are ignored.
    """
    daily = entries.select("list", "kind", "key", "dated", "blocks").dropna().groupBy(
        "list", "kind", "key", "dated").agg(F.max("blocks").alias("blocks"))
    own = Window.partitionBy("list", "kind", "key").orderBy("dated")
    return daily.withColumn("until", F.lead("dated").over(own)).where("blocks").select(
        "list", "kind", "key", F.col("dated").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at",
                period: str = PERIOD) -> DataFrame:
    """``captures`` with ``blocked``, ``n_active`` and ``lists`` as of the time each was fetched.

    ``entries``: ``list``, ``kind`` (``url``: that URL without fragment; ``host``: that host; ``domain``: that domain
    and all below it), ``key``, ``dated`` and ``blocks`` (false lifts an earlier entry). The as-of join is on the key
    and the period: an interval stands in every period it touches up to the last capture, and the condition on the
    day decides. Captures are reduced to distinct URLs a day before it, so a common page costs one row a day; a
    common host is one side of a plain join that AQE splits. Captures with a NULL URL or time match nothing; repeated
    rows all stay; without entries nothing is blocked. Columns of ``captures`` named like the results are replaced.
    """
    seen = captures.select(url_key(F.col(url)).alias("address"), host_of(F.col(url)).alias("host"),
                           F.col(fetched).cast("date").alias("day")).dropna().distinct()
    wanted = F.array_append(
        F.array_append(F.transform(parents(F.col("host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("key"))),
                       F.struct(F.lit("host").alias("kind"), F.col("host").alias("key"))),
        F.struct(F.lit("url").alias("kind"), F.col("address").alias("key")))
    keyed = seen.select("address", "day", F.trunc("day", period).alias("period"), F.explode(wanted).alias("k")).select(
        "address", "day", "period", "k.kind", "k.key")
    last = seen.agg(F.max("day")).first()[0]
    end = F.lit(last).cast("date")
    spans = intervals(entries).withColumn("end", F.least(F.coalesce(F.date_sub("until", 1), end), end))
    step = F.make_ym_interval(F.lit(1), F.lit(0)) if period == "year" else F.make_ym_interval(F.lit(0), F.lit(1))
    dealt = spans.where("since <= end").withColumn("period", F.explode(
        F.sequence(F.trunc("since", period).cast("date"), F.trunc("end", period).cast("date"), step)))
    active = keyed.join(dealt, ["kind", "key", "period"]).where("day >= since AND day <= end").groupBy(
        "address", "day").agg(F.count("*").alias("n_active"),
                              F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    base = captures.drop("blocked", "n_active", "lists")
    own = base.select(F.struct(*base.columns).alias("capture"), url_key(F.col(url)).alias("own_address"),
                      F.col(fetched).cast("date").alias("own_day"))
    found = own.join(active, (F.col("own_address") == F.col("address")) & (F.col("own_day") == F.col("day")), "left")
    return found.select("capture.*", F.col("n_active").isNotNull().alias("blocked"),
                        F.coalesce("n_active", F.lit(0)).alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"))
