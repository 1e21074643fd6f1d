"""The corpus pipeline over ``documents``: reject toxic texts, keep one of each group of near copies,
mask personal data, and pack what is left into sequences.

Each stage takes what its predecessor kept, written and read again.  Further columns pass through all
stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import packing, partenum, pii, toxicity
from orderflow.operators.keys import dense_index
from orderflow.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score calls them toxic go; a row's fate depends on its text alone."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """``names`` made so that no column of ``docs`` has them."""
    taken = {c.lower() for c in docs.columns}
    longest = max(map(len, docs.columns), default=0)
    return [n if n.lower() not in taken else n + "_" * (longest + 1) for n in names]


def _by_text(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``key``: the id, or where ids repeat the rank of id and text, so that each text has its own."""
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("n > 1").isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    (digest,) = _unused(docs, "_digest")
    digested = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")), 256))
    ranks = dense_index(digested.filter("doc_id is not null").select("doc_id", digest).distinct(), ["doc_id", digest], key)
    return stage(digested.join(ranks, ["doc_id", digest], "left").select(*docs.columns, key), "pipeline-keys")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, of the smallest id and under it of the smallest digest of its text.

    Rows without words, or without id, are in no group and stay, all of them.  Further columns pass
    through, whatever their names.
    """
    key, copy, first, rows = _unused(docs, "_text_key", "_copy", "_first", "_rows")
    keyed = _by_text(docs, key)
    found = partenum.join(keyed.select(F.col(key).alias("doc_id"), "text")).filter(F.col("n_shingles") > 0).filter("doc_id is not null")
    copies = found.groupBy("doc_id").agg(F.min("component_id").alias(first), F.count("*").alias(rows))
    # staged, so that its true size decides how it meets the documents
    copies = stage(copies.filter((F.col("doc_id") != F.col(first)) | (F.col(rows) > 1)).select(F.col("doc_id").alias(copy), first, rows), "pipeline-copies")
    marked = keyed.join(copies, F.col(key) == F.col(copy), "left")
    single = marked.filter(F.col(copy).isNull()).select(*docs.columns)
    # rows of one key have one text
    again = marked.filter(F.col(copy) == F.col(first)).dropDuplicates([key]).select(*docs.columns)
    return single.unionByName(again)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# No SQL can express the trained classifier; each stage is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
