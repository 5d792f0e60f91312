"""What indexes are for, on files: clustering, bucketing and term look-up."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None,
                    tie_break: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Files ordered by ``keys``: a filter on them skips files and row groups by their min/max.

    ``tie_break`` columns extend the range boundaries, so a hot key spreads over several files.
    """
    order = list(keys) + list(tie_break)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, mode: str = "errorifexists") -> None:
    """Catalogue table bucketed and sorted by ``keys``: joins and groupings on them need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def applicable_indexes(indexes: DataFrame, columns: DataFrame) -> DataFrame:
    """Add ``applicable``: every index column exists in its table.

    ``indexes``: table_name, index_name, columns (array). ``columns``: table_name, column_name. Index columns
    are matched one by one, so no table's column list is gathered. Both joins are merged, never broadcast: few bytes of
    files may make many columns, and every task would hold them all.
    """
    parts = indexes.select("table_name", "index_name", F.explode("columns").alias("column_name"))
    known = columns.select("table_name", "column_name").hint("merge")
    absent = parts.join(known, ["table_name", "column_name"], "left_anti")
    bad = absent.select("table_name", "index_name").distinct().withColumn("__absent", F.lit(True))
    return indexes.join(bad.hint("merge"), ["table_name", "index_name"], "left").withColumn(
        "applicable", F.col("__absent").isNull()).drop("__absent")


def document_indexes(indexes: DataFrame) -> DataFrame:
    """Collection indexes without ``_id_``, key paths as column names. ``keys`` is an array of dotted paths."""
    return indexes.where(F.col("index_name") != "_id_").withColumn(
        "columns", F.transform("keys", lambda k: F.lower(F.replace(k, F.lit("."), F.lit("_"))))).drop("keys")


def build_term_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term)`` of every text, lower case. Repeats are dropped inside the row, without a shuffle; a key of
    several rows may repeat a term."""
    words = F.split(F.lower(F.col(f"`{text}`")), r"[^\p{L}\p{N}_]+")
    terms = F.filter(F.array_distinct(words), lambda w: w != "")
    return df.select(F.col(f"`{key}`"), F.explode(terms).alias("term"))


def write_term_index(index: DataFrame, path: str, key: str, partitions: int | None = None,
                     mode: str = "errorifexists") -> None:
    """Term index clustered by term; frequent terms are split over files by key."""
    write_clustered(index, path, ["term"], partitions, tie_break=[key], mode=mode)


def search_terms(index: DataFrame, key: str, terms: Iterable[str]) -> DataFrame:
    """Keys whose texts hold all the terms, taken together when a key has several rows."""
    wanted = sorted({t.lower() for t in terms})
    return (index.where(F.col("term").isin(*wanted)).groupBy(F.col(f"`{key}`"))
            .agg(F.count_distinct("term").alias("matched")).where(F.col("matched") == len(wanted)).select(F.col(f"`{key}`")))


def _rank(column: Column, bounds: list) -> Column:
    """How many of the sorted bounds a value reaches, by halving; NULL ranks first."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(column >= F.lit(bounds[mid]), below(mid + 1, high)).otherwise(below(low, mid))

    return F.when(column.isNull(), F.lit(0)).otherwise(below(0, len(bounds)) + 1)


def curve_key(df: DataFrame, keys: Sequence[str], bits: int = 6, sample: int = 20000) -> Column:
    """A place on a space-filling curve (Morton order): the bits of the columns' ranks, interleaved.

    Ranks come from bounds of a bounded sample, so every column is cut into parts of equal size whatever its values
    are; a value that holds many rows is one part.
    """
    share = min(1.0, sample / max(1, df.count()))
    hashed = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1 << 30))
    rows = df.select(*[F.col(f"`{k}`") for k in keys]).where(hashed < int(share * (1 << 30))).limit(4 * sample).collect()
    place = F.lit(0).cast("bigint")
    for i, key in enumerate(keys):
        values = sorted(r[i] for r in rows if r[i] is not None)
        bounds = sorted({values[len(values) * j // (1 << bits)] for j in range(1, (1 << bits) - 1)}) if values else []
        rank = _rank(F.col(f"`{key}`"), bounds).cast("bigint")
        for bit in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(keys) + i))
    return place


def write_multi_clustered(df: DataFrame, path: str, keys: Sequence[str], partitions: int, bits: int = 6,
                          mode: str = "errorifexists") -> None:
    """Files that a filter on any of ``keys`` can skip: rows are dealt by ranges of a curve through all of them.

    Rows inside a file are ordered along the curve too, so row groups are skipped as well. A curve place with very many
    rows is spread over files by a hash of the row.
    """
    if len(keys) * bits > 62:
        raise ValueError("too many columns or bits for one 64-bit place")
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map" not in f.dataType.simpleString()])
    placed = df.withColumns({"__place": curve_key(df, keys, bits), "__tie": tie})
    placed.repartitionByRange(partitions, "__place", "__tie").sortWithinPartitions("__place").drop(
        "__place", "__tie").write.mode(mode).parquet(path)


def files_to_read(df: DataFrame, keys: Sequence[str], ranges: Sequence[tuple[str, object, object]]) -> DataFrame:
    """``filter, files, files_read, rows, rows_read``: what files of a table on disk a range filter can't skip.

    A filter is a column with its least and largest value; a file is read when its own smallest and largest overlap it.
    """
    wanted = {c for c, _, _ in ranges} | set(keys)
    bounds = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{c}`")).alias(f"{name}_{c}") for c in sorted(wanted)
                                        for name, f in (("min", F.min), ("max", F.max))])
    out = []
    for column, low, high in ranges:
        hit = (F.col(f"`max_{column}`") >= F.lit(low)) & (F.col(f"`min_{column}`") <= F.lit(high))
        out.append(F.struct(F.lit(column).alias("filter"), F.count(F.lit(1)).alias("files"), F.count_if(hit).alias("files_read"),
                            F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rows_read")))
    return bounds.agg(F.array(*out).alias("f")).select(F.inline("f"))
