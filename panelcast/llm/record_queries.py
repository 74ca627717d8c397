"""Queries op1, op2, op3, op4, op6 and op7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, chat, packing, sharding, vector_search, warc
from panelcast.llm.registry import query, table
from panelcast.llm.storage import scratch_path

RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
SHARD_BYTES = 1 << 20


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_file(RANKS)
    back = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return back.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 AS long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


TOP_K_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10"""


@query(TOP_K_SQL)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(WORD_TOKENIZER))


CHAT_SQL = """
WITH turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL)),
prefixes AS (
    SELECT conv_id, pos, n, string_agg(role || chr(1) || text, chr(2)) OVER (
        PARTITION BY conv_id ORDER BY pos) AS prefix FROM turns),
wholes AS (
    SELECT min(conv_id) AS conv_id, pos AS n_turns, count(*) AS n_copies, prefix
    FROM prefixes WHERE pos = n GROUP BY pos, prefix),
kept AS (SELECT * FROM wholes WHERE NOT EXISTS (
    SELECT 1 FROM prefixes AS p WHERE p.pos < p.n AND p.pos = wholes.n_turns AND p.prefix = wholes.prefix))
SELECT conv_id, n_turns, n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM kept JOIN turns USING (conv_id) GROUP BY conv_id, n_turns, n_copies"""


@query(CHAT_SQL)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


SHARD_SQL = f"""
WITH sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS row_bytes,
           ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:4])::INTEGER AS value FROM documents),
prefixes AS (
    SELECT doc_id, row_bytes, depth, lpad(bin(value), 16, '0')[1:depth] AS shard
    FROM sized, range(0, 17) AS t(depth)),
buckets AS (SELECT depth, shard, sum(row_bytes) AS shard_bytes FROM prefixes GROUP BY ALL),
fitting AS (
    SELECT doc_id, row_bytes, shard, depth, shard_bytes,
           row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS r
    FROM prefixes JOIN buckets USING (depth, shard) WHERE shard_bytes <= {SHARD_BYTES})
SELECT doc_id, shard, depth, row_bytes, shard_bytes, false AS oversized FROM fitting WHERE r = 1"""


@query(SHARD_SQL)
def op6_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


@query()
def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
