"""The numbered queries over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import alignment, bpe_codec, chat, kmeans_tree, packing, partenum, pfor, pii, spelling, token_counts, toxicity, vafile, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op3_bpe_codec")
def bpe_codec_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_decode(_table(spark, sf_dir, "documents"), _tokenizer())
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("op5_token_counts")
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer())


@_query("op9_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


CHECK_TEXT = "</s>[INST] ok [/INST]"


@_query("op1_chat_format")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CHECK_TEXT).alias("text"),
    )
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.format_chats(chats))


@_query("op7_pii")
def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *pii.counts(), F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


@_query(
    "op10_warc",
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
            min(page_id) OVER (PARTITION BY payload) AS first FROM p)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM d""",
)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages")).drop("payload")


@_query(
    "op4_exact_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10""",
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_table(spark, sf_dir, "embeddings"))


@_query("op8_kmeans_tree")
def kmeans_tree_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.neighbours(_table(spark, sf_dir, "embeddings"))


@_query("op2_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op6_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(_table(spark, sf_dir, "documents"))


@_query("op11_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(_table(spark, sf_dir, "documents"), _tokenizer(), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return found.withColumn("groups_sha256", digest).drop("groups")


@_query("op12_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


@_query("op13_token_id_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = pfor.binary_output(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return read.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
