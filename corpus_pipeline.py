"""Cleaning a corpus in stages; each stage's rows are written and read back before the next.

A stage is a function of (spark, docs, sf_dir). All but the last return the columns of docs, whatever
they are, so stages can be left out or put elsewhere. ``sf_dir`` is where the labels come from.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import (
    documents,
    new_name,
    of_files,
    stored,
    with_row_ids,
    with_settings,
)
from shelfcast.llm.line_dedup import LineParams, dedup_lines
from shelfcast.llm.mixing import mix_slots, root_weights
from shelfcast.llm.near_dups import NearParams, near_duplicates
from shelfcast.llm.packing import PackingParams, pack
from shelfcast.llm.queries import MIX_BLOCK, MIX_RESOLUTION
from shelfcast.llm.toxicity import (
    ToxicityParams,
    classifier_chain,
    production_labels,
    with_chances,
)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _columns(docs: DataFrame, changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of docs out of the struct ``doc``, some of them changed."""
    changed = changed or {}
    return [changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, trained on the labelled ones among docs, does not call toxic."""
    params = ToxicityParams()
    labels = production_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = new_name(docs, "chances")
    scored = with_chances(docs, classifier_chain(docs, labels, params), params, name)
    return scored.where(F.col(f"{name}.toxic") < params.threshold).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines, ``n_chars`` counted anew; those of
    which nothing is left go, those that were empty before stay."""
    found = dedup_lines(docs, LineParams())
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    cut = ~F.col("text").eqNullSafe(F.col("doc.text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(cut, n_chars).otherwise(F.col("doc.n_chars"))
    return found.where(left).select(*_columns(docs, changed))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the first by doc_id; repeated rows are copies."""
    rows = with_row_ids(docs)
    named = rows.select(F.struct("id", "row").alias("doc_id"), F.col("doc.text").alias("text"))
    kept = near_duplicates(named, NearParams()).where("kept").select("doc_id.id", "doc_id.row")
    return rows.join(kept, ["id", "row"], "left_semi").select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files and their rows follow it."""
    weights = root_weights(docs.select("source"), MIX_RESOLUTION)
    name = new_name(docs, "mixed")
    mixed = mix_slots(docs, stored(weights, "weights"), MIX_BLOCK, name)
    return mixed.orderBy(F.col(f"{name}.position")).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in buckets and batches, in the order in which docs are stored (rows
    that are not of files: by hash)."""
    return pack(docs, PackingParams(), stored_order=of_files(docs))


def _set(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(with_settings(spark), docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _set(drop_toxic)),
    ("line_dedup", _set(drop_repeated_lines)),
    ("near_duplicates", _set(drop_near_copies)),
    ("mixing", _set(mix_sources)),
    ("packing", _set(pack_documents)),
]

#: Learning and iteration are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
