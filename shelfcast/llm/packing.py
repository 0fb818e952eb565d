"""Packing into optimal length buckets.

The histogram of lengths over all documents has at most ``max_len`` entries, as longer documents are
cut into pieces of that length. Dynamic programming over it chooses the bucket boundaries with the
least padding. Inside each bucket, batches of a fixed number of pieces fill a token budget, counted
with the padding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stored, word_count


@dataclass(frozen=True)
class PackingParams:
    max_len: int = 4096
    n_buckets: int = 16
    batch_tokens: int = 65_536
    slices: int = 4096
    slice_rows: int = 10_000


def bucket_lengths(histogram: Sequence[tuple[int, int]], n_buckets: int) -> list[int]:
    """Ascending bucket lengths, n_buckets at most, with the least padding over a histogram of
    (length, count); each length goes to the smallest bucket that holds it.

    Of equally good choices the one whose last bucket starts earliest is taken.
    """
    pairs = sorted((int(size), int(n)) for size, n in histogram if n)
    if not pairs:
        return []
    size = np.array([p[0] for p in pairs], dtype=np.float64)
    count = np.concatenate([[0.0], np.cumsum([p[1] for p in pairs], dtype=np.float64)])
    d = len(pairs)
    best = np.full(d + 1, np.inf)  # least padded tokens of the first j lengths
    best[0] = 0.0
    cuts = []
    for _ in range(min(n_buckets, d)):
        nxt, cut = np.full(d + 1, np.inf), np.zeros(d + 1, dtype=np.int64)
        nxt[0] = 0.0
        for j in range(1, d + 1):
            cost = best[:j] + (count[j] - count[:j]) * size[j - 1]
            cut[j] = int(np.argmin(cost))
            nxt[j] = cost[cut[j]]
        best = nxt
        cuts.append(cut)
    chosen, j = [], d
    for cut in reversed(cuts):
        if j == 0:
            break
        chosen.append(int(size[j - 1]))
        j = int(cut[j])
    return sorted(chosen)


def written_order(file_name: Column) -> list[Column]:
    """Strings that sort file names as Spark numbers them: by task, then by file of the task, however
    many digits these have; other names sort by name."""
    numbers = [F.regexp_extract(file_name, p, 1) for p in ("^part-([0-9]+)", "-c([0-9]+)[.]")]
    return [*[F.lpad(n, 20, "0") for n in numbers], file_name]


def pack(
    docs: DataFrame,
    params: PackingParams,
    n_tokens: Column | None = None,
    stored_order: bool = False,
) -> DataFrame:
    """One row per piece of each row of docs (doc_id, text): piece, piece_start and piece_len in
    tokens, its bucket and bucket_len, the batch in that bucket and its place in the batch.

    A length is the number of words plus one end token unless n_tokens says otherwise; a null or
    empty text is one piece with the end token, and n_tokens below 1 count as 1. Rows of a bucket
    follow one another by a hash of doc_id, or with stored_order as they lie in the files that docs
    were read from. Rows are numbered inside slices of a bucket (of the hash, or of slice_rows rows
    of a file) and the slices' counts are summed up, so no bucket meets in one task. Repeated rows
    are packed each for itself, other columns are ignored, an empty table gives no rows.
    """
    hashed = F.xxhash64("doc_id")
    part = F.format_string("%04d", F.pmod(hashed, F.lit(params.slices)))
    place = hashed
    if stored_order:
        place = F.col("_metadata.row_index")
        number = F.format_string("%012d", F.floor(place / params.slice_rows))
        part = F.concat_ws(":", *written_order(F.col("_metadata.file_name")), number)
    length = word_count(F.col("text")) + 1 if n_tokens is None else n_tokens
    sized = docs.select(
        "doc_id",
        F.greatest(F.coalesce(length.cast("long"), F.lit(1)), F.lit(1)).alias("n_tokens"),
        part.alias("slice"),
        place.alias("place"),
    )
    sized = stored(sized, "lengths")
    start = F.col("piece") * params.max_len
    pieces = sized.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / params.max_len)))
    ).select(
        "doc_id",
        "slice",
        "place",
        "piece",
        start.alias("piece_start"),
        F.least(F.col("n_tokens") - start, F.lit(params.max_len)).alias("piece_len"),
    )
    histogram = pieces.groupBy("piece_len").count().collect()  # max_len rows at most
    lengths = bucket_lengths([tuple(r) for r in histogram], params.n_buckets) or [1]
    bounds = F.array(*[F.lit(n) for n in lengths])
    bucket = F.size(F.filter(bounds, lambda b: b < F.col("piece_len")))
    placed = pieces.withColumn("bucket", bucket).withColumn("bucket_len", F.get(bounds, "bucket"))
    counts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("bucket", "slice").orderBy("place", "doc_id", "piece")
    per_batch = F.greatest(F.floor(F.lit(params.batch_tokens) / F.col("bucket_len")), F.lit(1))
    return (
        placed.join(offsets, ["bucket", "slice"])
        .withColumn("row", F.col("before") + F.row_number().over(inside) - 1)
        .select(
            "doc_id",
            F.col("piece").cast("int").alias("piece"),
            F.col("piece_start").cast("long").alias("piece_start"),
            F.col("piece_len").cast("int").alias("piece_len"),
            F.col("bucket").cast("int").alias("bucket"),
            F.col("bucket_len").cast("int").alias("bucket_len"),
            F.floor(F.col("row") / per_batch).alias("batch"),
            F.pmod("row", per_batch).cast("int").alias("place"),
        )
    )
