"""The corpus pipeline: documents to token ids, in five stored stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import exact_dedup, jaccard_join, mixing, quality_classifier, subword_encoding
from shoplake.llm.common import fresh, screened
from shoplake.storage import materialize

#: Numbers of rows without an id of their own begin here; ids are less.
BEYOND = 1 << 62


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts: of good quality and not toxic."""
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the largest doc_id, of each group of equal texts."""
    stored = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return exact_dedup.kept_documents(docs, stored)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by 5-word shingles at 0.8.

    Rows that share an id, or have none, are compared each by itself: they are stored with a
    number beyond all ids, so of a group a row with an id of its own stays before them.
    Documents without words are linked with nothing and stay.
    """
    shared_id, dropped = fresh(docs, "id"), fresh(docs, "gone")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 or doc_id is null")
    shared = materialize(ids.select(F.col("doc_id").alias(shared_id)), "shared-ids")
    alike = F.col("doc_id").eqNullSafe(F.col(shared_id))
    usual, odd = docs, None
    if not shared.isEmpty():
        usual = docs.join(shared, alike, "left_anti")
        odd = docs.join(shared, alike, "left_semi").select(F.struct(*docs.columns).alias("doc"))
        odd = materialize(odd.withColumn("doc_id", BEYOND + F.monotonically_increasing_id()).select("doc_id", "doc.text", "doc"), "odd-rows")
    rows = usual.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classes = jaccard_join.jaccard_join(rows if odd is None else rows.unionByName(odd.select("doc_id", "text")), words=5, percent=80)
    gone = materialize(classes.where("component_id <> doc_id").select(F.col("doc_id").alias(dropped)), "near-copies")
    maybe, kept = screened(usual, "doc_id", gone)
    kept = kept.unionByName(maybe.join(gone, F.col("doc_id").cast("long") == F.col(dropped), "left_anti"))
    if odd is None:
        return kept
    return kept.unionByName(odd.join(gone, F.col("doc_id") == F.col(dropped), "left_anti").select("doc.*"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each time that a document is taken."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of every document of the mixture."""
    return subword_encoding.encode(docs)


#: Name and function of each stage, in order; all but the last return the columns of documents.
STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: A classifier and an encoder are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
