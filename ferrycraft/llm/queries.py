"""The queries of the training-data operators over the test tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrycraft.llm import (cosine_cells, fm_decontam, line_quality, piece_codec, pivot_simhash, quality_qda, secret_scan,
                            shard_packing, son_collocations, spelling_variants, suffix_dedup, token_blocks, url_lists)
from ferrycraft.session import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text and in its decoded layers."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
              for kind in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"), "skipped")


@query()
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the content share of every text."""
    docs = table(spark, sf_dir, "documents")
    judged = line_quality.judge(docs, line_quality.fit(docs, table(spark, sf_dir, "labels")))
    return judged.drop("content")


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without its 400-byte repeats."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text and the text they decode to, as digests."""
    coded = piece_codec.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                               decoded=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op10_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word SimHash, linked at two differing bits or fewer."""
    found = pivot_simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op5_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores learned outside the held-out fold."""
    return quality_qda.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS passage
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
found AS (
    SELECT doc_id, i, s.n, item FROM (
        SELECT doc_id, i, l.n, array_to_string(w[i:i + l.n - 1], ' ') AS passage
        FROM (SELECT DISTINCT n FROM windows) l, docs, unnest(range(1, len(w) - l.n + 2)) AS t(i)) s
    JOIN windows USING (n, passage)),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)
""")
def op6_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word benchmark passages in every document."""
    found = fm_decontam.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _dated(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and list entries made from the pages: a fetch day for each, and for each address, host and domain
    an entry, a later one that lifts it and one that sets it again, dated by the pages that have it."""
    day = F.expr("date_add(date '2023-01-01', cast(page_id * 37 % 1096 AS int))")
    captures = pages.select("page_id", "url", day.alias("fetched_at"))
    host = url_lists.host_of(F.col("url"))
    own = pages.select("page_id", F.explode(F.array(
        F.struct(F.lit("pages").alias("list"), F.lit("url").alias("kind"), url_lists.url_key(F.col("url")).alias("key")),
        F.struct(F.lit("hosts").alias("list"), F.lit("host").alias("kind"), host.alias("key")),
        F.struct(F.lit("domains").alias("list"), F.lit("domain").alias("kind"),
                 F.element_at(url_lists.parents(host), 2).alias("key")))).alias("e"))
    known = own.where("e.key IS NOT NULL").groupBy("e.list", "e.kind", "e.key").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = "date_add(date '2023-01-01', cast(first * 91 % 700 AS int))"
    moves = F.expr(f"""array(named_struct('dated', {first}, 'blocks', true),
        named_struct('dated', date_add({first}, cast(20 + n * 13 % 200 AS int)), 'blocks', false),
        named_struct('dated', date_add({first}, cast(300 + n * 7 % 90 AS int)), 'blocks', true))""")
    return captures, known.select("list", "kind", "key", F.explode(moves).alias("m")).select("list", "kind", "key", "m.*")


@query(r"""
WITH captures AS (
    SELECT page_id, url, DATE '2023-01-01' + CAST(page_id * 37 % 1096 AS INTEGER) AS fetched_at,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*') AS head,
        lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1),
            '^.*@', ''), '\.?(:[0-9]*)?$', '')) AS host
    FROM pages),
addressed AS (
    SELECT *, lower(head) || regexp_replace(substr(url, length(head) + 1), '#.*$', '') AS address,
        string_split(host, '.') AS labels FROM captures),
known AS (
    SELECT list, kind, key, min(page_id) AS first, count(*) AS n FROM (
        SELECT page_id, 'pages' AS list, 'url' AS kind, address AS key FROM addressed
        UNION ALL SELECT page_id, 'hosts', 'host', host FROM addressed
        UNION ALL SELECT page_id, 'domains', 'domain', array_to_string(labels[2:], '.') FROM addressed
            WHERE len(labels) > 2)
    WHERE key IS NOT NULL GROUP BY ALL),
entries AS (
    SELECT list, kind, key, DATE '2023-01-01' + CAST(first * 91 % 700 AS INTEGER) AS dated, true AS blocks FROM known
    UNION ALL SELECT list, kind, key,
        DATE '2023-01-01' + CAST(first * 91 % 700 + 20 + n * 13 % 200 AS INTEGER), false FROM known
    UNION ALL SELECT list, kind, key,
        DATE '2023-01-01' + CAST(first * 91 % 700 + 300 + n * 7 % 90 AS INTEGER), true FROM known),
keys AS (
    SELECT page_id, fetched_at, 'url' AS kind, address AS key FROM addressed
    UNION ALL SELECT page_id, fetched_at, 'host', host FROM addressed
    UNION ALL SELECT page_id, fetched_at, 'domain', array_to_string(labels[i:], '.')
        FROM addressed, unnest(range(1, greatest(len(labels), 2))) AS t(i)),
latest AS (
    SELECT page_id, list, arg_max(blocks, (dated, blocks)) AS blocks
    FROM keys JOIN entries USING (kind, key) WHERE dated <= fetched_at GROUP BY page_id, list, kind, key)
SELECT c.page_id, c.url, c.fetched_at, count(l.list) > 0 AS blocked, count(l.list) AS n_active,
    coalesce(string_agg(DISTINCT l.list, ',' ORDER BY l.list), '') AS lists
FROM captures c LEFT JOIN latest l ON l.page_id = c.page_id AND l.blocks
GROUP BY c.page_id, c.url, c.fetched_at
""")
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against dated lists of addresses, hosts and domains, as of its fetch day."""
    return url_lists.filter_urls(*_dated(table(spark, sf_dir, "pages")))


@query()
def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids in files of patched frame-of-reference blocks, read back."""
    path = new_path(spark, "tokens")
    token_blocks.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return token_blocks.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op9_shard_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of near equal bytes; equal texts stay together."""
    return shard_packing.pack_shards(table(spark, sf_dir, "documents"), shards=40)


@query()
def op11_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more with their near words, the form each stands for, and the root of forms."""
    return spelling_variants.spelling_variants(spelling_variants.count_words(table(spark, sf_dir, "documents")))


@query("""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a AS node, a AS seen FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
LEFT JOIN (SELECT node, min(seen) AS low FROM reach GROUP BY node) ON node = vec_id
""")
def op12_cosine_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of equal label linked at a cosine of 0.98 or more."""
    return cosine_cells.link_vectors(table(spark, sf_dir, "embeddings"))


@query(r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM documents),
f AS (
    SELECT lang, size, phrase, count(*) AS n FROM (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
        FROM pieces, unnest([1, 2, 3]) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i))
    GROUP BY lang, size, phrase),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.n AS l, y.n AS r,
        CAST(1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holders AS (
    SELECT lang, part, max(a) AS most FROM (
        SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM candidates WHERE size = 3
        UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE size = 3) GROUP BY lang, part)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    total AS n, score
FROM best b JOIN totals USING (lang) LEFT JOIN holders h ON h.lang = b.lang AND h.part = b.phrase
WHERE most IS NULL OR 100 * most < 50 * a
QUALIFY rank <= 2000
""")
def op13_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best two- and three-word phrases of each language."""
    return son_collocations.collocations(table(spark, sf_dir, "documents"))
