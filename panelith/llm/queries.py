"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelith.llm.chat_format import ANSWERS, CHAT_SQL, CONFLICT, chat_digest, format_chats
from panelith.llm.hard_negatives import NEGATIVES_SQL, mine_hard_negatives
from panelith.llm.imatch import fingerprint_documents
from panelith.llm.language_id import fit_tagger, held_out, identify
from panelith.llm.minhash_dedup import near_duplicates
from panelith.llm.mixing import MIX_SQL, mix_sources
from panelith.llm.nearest import nearest_neighbours
from panelith.llm.periodic_runs import periodic_runs, repeated_tail, run_digest
from panelith.llm.pieces import encode_texts
from panelith.llm.pii import find_personal, personal_digest
from panelith.llm.quality import classify_quality
from panelith.llm.substring_dedup import dedup_substrings
from panelith.llm.token_counts import count_tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("intervals")


def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = fit_tagger(docs.where(~held_out()))
    return identify(docs, tagger).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conflict = spark.sql(
        "SELECT CAST(c AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, x AS text "
        f"FROM VALUES (-7, 0, 'user', '{CONFLICT}'), (-7, 1, '{ANSWERS}', '{CONFLICT}') AS v(c, t, r, x)"
    )
    return chat_digest(format_chats(chats.unionByName(conflict)))


def op7_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_pieces", "ids", "exact")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_digest(find_personal(table(spark, sf_dir, "documents")))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return mine_hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(table(spark, sf_dir, "documents"), repeated_tail))


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mixing, op2_substring_dedup, op3_quality_resampling, op4_language_id, op5_nearest_neighbours, op6_chat_format,
        op7_imatch_fingerprints, op8_sentencepiece, op9_minhash_near_dedup, op10_personal_data,
        op11_token_counts, op12_hard_negatives, op13_periodic_runs,
    )
}
SQL: dict[str, str] = {"op1_source_mixing": MIX_SQL, "op6_chat_format": CHAT_SQL, "op12_hard_negatives": NEGATIVES_SQL}
