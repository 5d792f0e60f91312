"""A training-corpus pipeline of the operators in ``ferrycraft.llm``: one Parquet table after each stage.

Every stage takes what its predecessor kept and, but for the last, returns the columns of ``documents``. Columns are
carried through as one value, so extra ones may have any names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrycraft.llm import fm_decontam, line_quality, near_copies, piece_codec, secret_scan
from ferrycraft.session import stage


def _folded(docs: DataFrame) -> DataFrame:
    """``(row, text)``: all columns but the text as one value."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"), "text")


def _unfolded(rows: DataFrame, columns: list[str], **changed) -> DataFrame:
    """The columns of the documents again, changed ones by expressions over ``row`` and ``text``."""
    own = {c: F.col("text") if c == "text" else F.col("row")[c] for c in columns}
    return rows.select(*((changed | {c: own[c] for c in columns if c not in changed})[c].alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose content lines hold half of the words."""
    field = line_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = line_quality.judge(_folded(docs), field, key="row", keep_text=True)
    return _unfolded(judged.where("kept"), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word Jaccard similarity of 0.8 or more, in chains) one row.

    It is the row with the least doc_id, then the least digest of its text. Every row is judged by its own text, also
    where rows share a doc_id; documents without a doc_id all stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    kept = near_copies.first_of_each(named, "doc_id").select("doc.*")
    return kept.select([F.col(f"`{c}`") for c in docs.columns]).union(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = fm_decontam.find_passages(_folded(docs), benchmark, key="row", keep_text=True)
    return _unfolded(found.where("n_hit = 0"), docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the secrets in it, plain or encoded, masked.

    Streams that ask for a window of over ``secret_scan.WINDOW_BYTES`` are not unwrapped and stay as they are.
    """
    found = secret_scan.scan_secrets(_folded(docs), key="row", keep_text=True)
    clean = secret_scan.masked(F.col("text"), F.col("spans"))
    return _unfolded(found, docs.columns, text=clean, **(
        {"n_chars": F.length(clean).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}))


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to."""
    ids = piece_codec.encode(_folded(docs), public_tokenizers.path("piece_bpe_32k.model"), key="row", decoded=True)
    return ids.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
                      F.col("row.lang").alias("lang"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                      F.col("decoded").alias("text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_codec", sentencepiece_codec),
]
#: No SQL: a trained field, fingerprints and a tokenizer decide. tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
