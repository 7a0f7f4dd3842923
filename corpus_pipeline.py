"""From raw documents to token ids: filter, deduplicate, sanitise, mix, encode.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir), gets the rows that its
predecessor kept, and all but the last return the columns of documents. ``run`` writes each stage's
rows below ``spark.checkpoint.dir`` and hands what it reads back to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelith.llm.minhash_dedup import near_duplicates
from panelith.llm.mixing import mix_documents
from panelith.llm.pieces import encode_texts
from panelith.llm.pii import sanitise
from panelith.llm.quality import filter_quality
from panelith.llm.staging import Stage, free_names

#: near duplicates share 0.8 of their shingles of five words, or more
SHINGLE = 5


def filter_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; the others go."""
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest doc_id.

    Of rows equal in doc_id and text one stays. Documents without words form no group; all stay. An empty table
    gives an empty table. Columns of any name pass.
    """
    found = near_duplicates(docs, width=SHINGLE)
    key = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("key"), "row")
    stage = Stage(spark, "near")
    found = stage.write(found.where("family IS NOT NULL").select("doc_id", "row", "family", key.alias("place")))
    first = stage.write(found.groupBy("family").agg(F.min("place").alias("first")))
    gone = found.join(first, "family").where("place <> first").select("doc_id", "row").distinct()
    text, its_id, its_text = free_names(docs, "__text", "__doc_id", "__row")
    gone = gone.toDF(its_id, its_text)
    rows = docs.withColumn(text, F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col(its_id)) & (F.col(text) == F.col(its_text)), "left_anti"
    )
    # repeated rows of the document that stays
    if not found.groupBy("doc_id", "row").count().where("count > 1").isEmpty():
        blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        rows = rows.where(~blank).dropDuplicates(["doc_id", text]).unionByName(rows.where(blank))
    return rows.drop(text)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing terms masked."""
    return sanitise(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it (never, once or twice)."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, and whether they decode to it."""
    return encode_texts(docs, ("doc_id", "lang", "source")).drop("decoded")


STAGES = [
    ("quality classifier", filter_by_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_to_weights),
    ("SentencePiece encoding and decoding", encode),
]
#: importance resampling and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table; none if it is empty."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, function) in enumerate(STAGES):
        docs, before = function(spark, docs, sf_dir), docs
        if i + 1 < len(STAGES):
            docs = stage.write(docs)
            stage.drop(before)
    return docs
