"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import shelfcast
from shelfcast.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Smaller Arrow batches bound what a Python worker holds of long texts. In Spark 4.1 a union that
#: keeps its inputs' partitioning can fail when AQE changes one of them.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.unionOutputPartitioning": "false",
}


_shipped_to: list[str] = []


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions in tasks can be
    imported wherever the driver got the package from."""
    app = spark.sparkContext.applicationId
    if app not in _shipped_to:
        package = Path(shelfcast.__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="shelfcast-code-")  # on the driver, which serves the file
        archive = Path(folder) / "shelfcast_code.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for path in sorted(package.rglob("*.py")):
                packed.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped_to.append(app)


def with_settings(spark: SparkSession) -> SparkSession:
    ship_code(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_settings(spark).read.parquet(f"{sf_dir}/embeddings.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def of_files(docs: DataFrame) -> bool:
    """Whether docs are rows of files as they lie there, with a file and a place for each."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def with_row_ids(docs: DataFrame) -> DataFrame:
    """Rows (doc, id, row): doc holds all columns, (id, row) tells rows apart and orders them by
    doc_id, nulls first; the same in each scan. Rows of files are told apart by file and place, any
    others are stored first."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id")
    if of_files(docs):
        row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row")
        return docs.select(whole, doc_id, row)
    return stored(docs.select(whole, doc_id, F.monotonically_increasing_id().alias("row")), "rows")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8; none for null."""
    return text.encode().lower().split() if text else []


class _WordHashes(dict):
    """64-bit hashes of words; the words first met are remembered, which are the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 100_000 and len(word) < 64:
            self[word] = value
        return value


_hashes = _WordHashes()


def hashed_words(text: str | None) -> np.ndarray:
    """The words of a text as 64-bit hashes; chance makes two of a billion words equal in one
    corpus of forty."""
    found = words(text)
    return np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    v = values ^ (values >> np.uint64(32))
    v = v * np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def new_name(df: DataFrame, name: str) -> str:
    """name, or a longer one that no column of df has (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_cells(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_rows: int,
    right_rows: int,
    left_id: str,
    right_id: str,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with columns ``cl`` and ``cr``, so that each left row of a key meets each right
    row of that key in one cell (keys, cl, cr) of about left_rows by right_rows rows at most.

    A key of any size is thus shared out over as many tasks as it needs; rows go to cells by the
    hash of their id. Keys that one side lacks are left out.
    """
    keys = list(keys)
    n_left = left.groupBy(*keys).agg(F.ceil(F.count("*") / left_rows).cast("int").alias("nl"))
    n_right = right.groupBy(*keys).agg(F.ceil(F.count("*") / right_rows).cast("int").alias("nr"))
    sizes = stored(n_left.join(n_right, keys), "cells")

    def at(col: str, n: str) -> Column:
        return F.pmod(F.xxhash64(F.col(col)), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    lefts = left.join(sizes, keys).withColumn("cl", at(left_id, "nl")).withColumn("cr", every("nr"))
    rights = right.join(sizes, keys).withColumn("cr", at(right_id, "nr")).withColumn("cl", every("nl"))
    rights = rights.drop("nl", "nr")
    # new column ids, as both sides may come from the same rows
    return lefts.drop("nl", "nr"), rights.select(*[F.col(c).alias(c) for c in rights.columns])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a, b), as rows (node, component), component the smallest
    node reachable; nodes without a link to another node are not listed.

    Rounds of large stars and small stars (each node's neighbours link to its smallest neighbour)
    on links in both directions. A round is two aggregates and two joins, so no node's neighbours
    meet in one task unless Spark can split them; rounds grow with the logarithm of the longest
    chain. Each round is stored, the driver sees only its number of links and their sums.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = stored(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        now = stored(small, "links")
        state = now.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.count_distinct("a"),
        ).first()
        if state[0] == state[2] and state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
