"""Reporting queries over the normalised tables, and working forms of constructs the scan advises on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .normalize import json_array


def orders_with_items(orders: DataFrame, items: DataFrame, products: DataFrame, order_key: str, item_order: str,
                      item_product: str, product_key: str, where: Column, newest_first: Sequence[Column]) -> DataFrame:
    """Orders that satisfy ``where`` with their items and products, newest first."""
    chosen = orders.where(where)
    return (chosen.join(items, chosen[order_key] == items[item_order])
            .join(products, items[item_product] == products[product_key]).orderBy(*newest_first))


def search_by_tag(products: DataFrame, key: str, tags: DataFrame, tag_key: str, tag: str, where: Column) -> DataFrame:
    """Products that carry the tag and satisfy ``where``: a semi join, so no DISTINCT is needed."""
    tagged = tags.where(F.col("tag") == tag).select(F.col(tag_key).alias(key))
    return products.where(where).join(tagged, key, "left_semi")


def json_contains(text: Column, value: str) -> Column:
    """True when the JSON array holds the string."""
    strings = F.transform(json_array(text), lambda v: F.when(
        F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.array_contains(strings, value)


def group_rating(df: DataFrame, key: str, rating: str) -> DataFrame:
    """``review_count`` and ``avg_rating`` (two digits) per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("review_count"), F.round(F.avg(rating), 2).alias("avg_rating"))


def top_products(items: DataFrame, products: DataFrame, item_product: str, item_order: str, qty: str, price: str,
                 product_key: str, product_name: str, n: int = 10) -> DataFrame:
    """Products with the highest revenue, and the number of orders they occur in.

    Items are combined per product before the join, so the join sees one row per product and a hot product
    is reduced on the map side. Ties are broken by product key.
    """
    money = lambda c: F.col(f"`{c}`").cast("decimal(12,2)")
    per_order = items.groupBy(item_product, item_order).agg(F.sum(money(qty) * money(price)).alias("revenue"))
    per_product = per_order.groupBy(item_product).agg(
        F.sum("revenue").alias("revenue"), F.count(item_order).alias("order_count"))
    named = per_product.join(products.select(product_key, product_name), F.col(item_product) == F.col(product_key))
    return named.select(
        product_key, product_name, F.col("revenue").cast("decimal(38,4)").alias("revenue"), "order_count",
    ).orderBy(F.desc("revenue"), F.asc(product_key)).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows of every group (what CROSS APPLY … TOP n does).

    Spark limits each group on the map side before the shuffle, so a hot group sends at most ``n`` rows per task.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def outer_top_per_group(parents: DataFrame, key: str, children: DataFrame, child_key: str, order: Sequence[Column], n: int,
                        rank: str = "rn") -> DataFrame:
    """Every parent with its first ``n`` children, or with NULLs when it has none (what OUTER APPLY … TOP n does)."""
    first = top_per_group(children, [child_key], order, n, rank)
    return parents.join(first, parents[key] == first[child_key], "left")


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str], amount: Column) -> DataFrame:
    """PIVOT with a fixed value list, so no extra pass looks for the values."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(amount)


def concat_per_group(df: DataFrame, group: Sequence[str], value: str, alias: str = "joined", sep: str = ",") -> DataFrame:
    """Distinct values of each group as one ordered, separated text (what FOR XML PATH is used for).

    Values are made distinct first; meant for columns with few values per group.
    """
    distinct = df.select(*group, value).distinct()
    return distinct.groupBy(*group).agg(
        F.array_join(F.sort_array(F.collect_list(value)), sep).alias(alias))


def date_arithmetic(df: DataFrame, ts: str, days: int, until: Column) -> DataFrame:
    """Forms of DATEADD, DATEDIFF and CONVERT to a date."""
    return df.withColumns({
        "added": F.timestamp_add("DAY", F.lit(days), F.col(ts)),
        "days_between": F.timestamp_diff("DAY", F.col(ts), until),
        "as_date": F.col(ts).cast("date"),
    })


# Date styles of CONVERT as patterns.
CONVERT_STYLES = {101: "MM/dd/yyyy", 103: "dd/MM/yyyy", 104: "dd.MM.yyyy", 112: "yyyyMMdd", 120: "yyyy-MM-dd HH:mm:ss"}


def is_null(value: Column, instead: Column) -> Column:
    """ISNULL(value, instead)."""
    return F.coalesce(value, instead)


def convert(value: Column, target: str, style: int | None = None) -> Column:
    """CONVERT(target, value, style): an instant as text in a style, or a cast that gives NULL where it fails."""
    if style is not None:
        return F.date_format(value, CONVERT_STYLES[style])
    return value.try_cast(target)


def before_now(ts: Column) -> Column:
    """Whether an instant lies before GETDATE()."""
    return ts < F.current_timestamp()
