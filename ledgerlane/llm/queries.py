"""The queries of the operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import audit, chat, sharding, trie
from ledgerlane.llm.decontaminate import overlaps
from ledgerlane.llm.jaccard import similar_components
from ledgerlane.llm.language import identify
from ledgerlane.llm.pieces import encode_documents
from ledgerlane.llm.quality import score_quality
from ledgerlane.llm.simhash import near_duplicates
from ledgerlane.llm.tables import read_table
from ledgerlane.llm.tokencount import counted_and_edited
from ledgerlane.llm.topk import exact_top_k
from ledgerlane.llm.toxicity import score_toxicity


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counted_and_edited(read_table(spark, folder, "documents"))


def simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


def sentencepiece_codec(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return encode_documents(docs).drop("text")


def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return overlaps(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), shortest_item=1)


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(read_table(spark, folder, "documents"))


#: Bytes of a shard that a loader takes in one request; a table of any of the given sizes splits at it.
LOADER_SHARD_BYTES = 1 << 16


def sharded(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, folder, "documents"), limit=LOADER_SHARD_BYTES)


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = chat.with_probe(read_table(spark, folder, "conversations"))
    return chat.read_back(chat.format_conversations(turns))


def exact_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(read_table(spark, folder, "embeddings"), F.col("id") % 50 == 0, 5)


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.filter_audit(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(read_table(spark, folder, "conversations"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_components(read_table(spark, folder, "documents"))


TOP_K_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts,
    "op2_simhash_dedup": simhash_dedup,
    "op3_language_id": language_id,
    "op4_sharding": sharded,
    "op5_chat_formatting": chat_formatting,
    "op6_sentencepiece_codec": sentencepiece_codec,
    "op7_exact_top_k": exact_top_k_search,
    "op8_quality_classifier": quality_classifier,
    "op9_benchmark_decontamination": benchmark_decontamination,
    "op10_toxicity": toxicity,
    "op11_filter_audit": filter_audit,
    "op12_conversation_trie": conversation_trie,
    "op13_jaccard_join": jaccard_join,
}

ORACLE_SQL: dict[str, str] = {
    "op4_sharding": sharding.oracle_sql(LOADER_SHARD_BYTES),
    "op5_chat_formatting": chat.ORACLE_SQL,
    "op7_exact_top_k": TOP_K_SQL,
    "op11_filter_audit": audit.ORACLE_SQL,
    "op12_conversation_trie": trie.ORACLE_SQL,
}
