"""The registered queries of the operators, over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import oracle
from shoplake.llm.decontamination import decontaminate
from shoplake.llm.exact_dedup import exact_dedup
from shoplake.llm.jaccard_join import jaccard_join
from shoplake.llm.lm_scoring import lm_score
from shoplake.llm.manifest import folded, leaf_digest, manifest, siblings
from shoplake.llm.mixing import taken
from shoplake.llm.nearest_neighbours import nearest
from shoplake.llm.ordering import numbered
from shoplake.llm.prefix_trie import trie_nodes
from shoplake.llm.quality_classifier import keeps, score
from shoplake.llm.sharding import shard
from shoplake.llm.subword_encoding import decode, encode
from shoplake.llm.substring_dedup import substring_dedup
from shoplake.llm.token_counts import token_counts
from shoplake.storage import materialize

Query = Callable[[SparkSession, str], DataFrame]


#: Letters that are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(_documents(spark, sf))


def op2_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return nearest(rows, F.col("vec_id") % 100 == 0)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return taken(_documents(spark, sf))


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an even id checksum stand for a stored snapshot, the others for a new batch."""
    stored = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return exact_dedup(_documents(spark, sf), stored).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm_score(_documents(spark, sf), held_out)


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.transform("removed", lambda r: F.format_string("%d-%d:%d@%d", r.start, r.stop, r.kept_id, r.kept_start))
    return substring_dedup(_documents(spark, sf), "sentence").select(
        "doc_id", "text", "n_removed", F.array_join(spans, ",").alias("removed")
    )


def op7_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join(_documents(spark, sf), words=4, percent=85)


def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return score(_documents(spark, sf), labels, ["quality", "toxic"]).withColumn("keep", keeps())


def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard(_documents(spark, sf), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_subword_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Length and digest of each text's ids, and digest of the text that they decode to."""
    return decode(encode(_documents(spark, sf))).select(
        "doc_id", F.size("ids").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), F.xxhash64("text").alias("text_hash")
    )


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _crc(number: str) -> Column:
    return F.crc32(F.col(number).cast("string").cast("binary"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos from 1, role, text) and ids of the conversations that begin with another's turns.

    Conversation c begins with the first h turns of c - c % 20, h being crc32(c) % 4, and
    goes on with its own after its first h. Turns ascend, null first; equal ones by role and
    text. Rows without a conv_id belong to no conversation.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")],
        F.monotonically_increasing_id().alias("row"),
    )
    placed = materialize(numbered(materialize(rows, "turns"), ["conv_id"], ["turn", "role", "text", "row"], "at", "size"), "turns-placed")
    sizes = placed.where("at = 0").select("conv_id", "size")
    head = F.pmod(_crc("conv_id"), F.lit(4))
    heads = sizes.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("given"))
    heads = heads.join(bases, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    heads = materialize(heads, "turn-heads")
    own = placed.join(heads, "conv_id").where("at >= h").withColumn("pos", F.col("given") + F.col("at") - F.col("h") + 1)
    early = placed.where("at < 3").withColumnRenamed("conv_id", "base").drop("size")
    lent = early.join(heads, "base").where("at < h").withColumn("pos", F.col("at") + 1)
    columns = ["conv_id", F.col("pos").cast("long").alias("pos"), "role", "text"]
    return materialize(own.select(*columns).unionByName(lent.select(*columns)), "turns-rebuilt"), sizes.select("conv_id")


def op12_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie_nodes(*rebuilt(spark.read.parquet(f"{sf}/conversations.parquet")))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Proofs of all documents, checked against leaves of which some were tampered with."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    altered = F.when(tampered, leaf_digest(F.translate("text", UPPER, UPPER.lower())))
    proofs = manifest(_documents(spark, sf), {"altered": altered}).proofs()
    seen = F.coalesce("what.altered", "digest")
    return proofs.select(
        "what.doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(siblings(F.col("path")), ""), 256).alias("proof_sha256"),
        folded(seen, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_sharding": op9_sharding,
    "op10_subword_encoding": op10_subword_encoding,
    "op11_decontamination": op11_decontamination,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op4_exact_dedup": oracle.EXACT_DEDUP,
    "op11_decontamination": oracle.DECONTAMINATION,
    "op12_conversation_trie": oracle.TRIE,
    "op13_merkle_manifest": oracle.MERKLE,
}
