"""Awkward tables that every operator of the subpackage must take."""

from pyspark.sql import functions as F

LONG = "word " * 30000 + "Long long text with é and 日本 marks. " * 2000
TEXTS = [None, "", " \t\n\r ", "one", "Two words", LONG, LONG, "Ends here.\n" * 30,
         "The same text in two rows, long enough to be more than a few words.",
         "The same text in two rows, long enough to be more than a few words.", "\x00\x1c nul",
         "|||| #### $$$$ %%%%", "日本語のテキスト 空白 なし", "a▁b ▁ c"]
#: Names that operators use inside; a table may have them too.
CLASHES = ["print", "node", "group", "unit", "piece", "shard", "row", "size", "id", "gram", "key", "of", "own", "class",
           "label", "kept", "n_words", "statistics", "ids", "spans", "part", "at", "crc", "component_id", "lines"]


def edge_docs(spark, texts=TEXTS):
    """Keys 0 …, one row twice, one NULL key; and columns of clashing names."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no key here")]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def with_clashes(df):
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHES)))


def empty_docs(spark):
    return with_clashes(spark.createDataFrame([], "doc_id long, text string"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
