"""Queries of this package, one for each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.ann import AnnParams, nearest_by_hashing
from shelfcast.llm.chat import format_chats, read_loss, read_turns
from shelfcast.llm.class_lm import ClassLmParams, class_lm_scores
from shelfcast.llm.common import documents, embeddings, with_settings
from shelfcast.llm.line_dedup import LineParams, dedup_lines
from shelfcast.llm.mixing import mix_slots, root_weights
from shelfcast.llm.near_dups import NearParams, near_duplicates
from shelfcast.llm.ns_means import MeansParams, cluster_vectors
from shelfcast.llm.oracle import CHAT_SQL, MEANS_SQL, MIXING_SQL, NEAR_SQL, SPELLING_SQL, TOP_K_SQL
from shelfcast.llm.packing import PackingParams, pack
from shelfcast.llm.pii import find_personal_data
from shelfcast.llm.spelling import VariantParams, spelling_variants, word_counts
from shelfcast.llm.token_counts import Vocabulary, token_counts
from shelfcast.llm.topk import TopKParams, exact_top_k
from shelfcast.llm.toxicity import (
    ToxicityParams,
    classifier_chain,
    production_labels,
    with_chances,
)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MIX_RESOLUTION, MIX_BLOCK = 1000, 16
TYPO_EVERY = 31


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), Vocabulary.read(VOCABULARY))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_hashing(embeddings(spark, sf_dir), F.col("vec_id") % 20 == 0, AnnParams())


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm_scores(documents(spark, sf_dir), ClassLmParams())


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), NearParams())


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), PackingParams())


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source")
    mixed = mix_slots(docs, root_weights(docs, MIX_RESOLUTION), MIX_BLOCK)
    return mixed.select("doc_id", "source", "mixed.*")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0, TopKParams())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, params = documents(spark, sf_dir), ToxicityParams()
    labels = production_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = with_chances(docs, classifier_chain(docs, labels, params), params, "p")
    return scored.select(
        "doc_id",
        F.col("p.low_quality").alias("p_low_quality"),
        F.col("p.toxic").alias("p_toxic"),
        (F.col("p.toxic") >= params.threshold).alias("toxic"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir), LineParams())
    return found.select(
        "doc.doc_id",
        "n_lines",
        "n_removed",
        F.coalesce(F.length("text"), F.lit(0)).alias("kept_chars"),
        F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = VariantParams()
    return spelling_variants(word_counts(documents(spark, sf_dir), params, TYPO_EVERY), params)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_settings(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    rows = rows.select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    told = format_chats(rows.unionByName(marked)).withColumn("turns", read_turns(F.col("formatted")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.withColumn("learnt", read_loss(F.col("segments"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_blocks",
        F.sha2("formatted", 256).alias("formatted_sha256"),
    )


def op13_ns_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(embeddings(spark, sf_dir), MeansParams()).drop("evaluated")


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_nearest_vectors,
        op3_class_lm,
        op4_near_duplicates,
        op5_packing,
        op6_source_mixing,
        op7_exact_top_k,
        op8_toxicity,
        op9_line_dedup,
        op10_personal_data,
        op11_spelling_variants,
        op12_chat_format,
        op13_ns_means,
    )
}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": NEAR_SQL,
        "op6_source_mixing": MIXING_SQL,
        "op7_exact_top_k": TOP_K_SQL,
        "op11_spelling_variants": SPELLING_SQL,
        "op12_chat_format": CHAT_SQL,
        "op13_ns_means": MEANS_SQL,
    }
