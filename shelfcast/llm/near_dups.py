"""Near-duplicates by a multi-index Hamming join of MinHash signatures.

A document's set holds its distinct five-word shingles as 64-bit hashes; documents with the same set
form a class at once. A class's signature has ``n_chunks`` chunks of ``chunk`` MinHash values of 16
bits each. By the pigeonhole principle two signatures that differ in fewer than
``n_chunks * (errors + 1)`` values agree in some chunk up to ``errors`` values; each chunk is indexed
once for every choice of the values that may be wrong, so every such pair meets under some key. With
10 chunks of 4 values and one error that is a distance of 19 of 40 at least; at a similarity of 0.75
a pair shares no key with a chance of 2 in a million.

Classes that meet under keys hang together in candidate groups. A group is shared out over cells of
two blocks of its members; a cell confirms links between members that share a key on their full
sets, passing over pairs it has already found connected, and gives a spanning forest. Groups of very
many members are taken key by key instead. Only links leave a cell, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import components, hashed_words, mixed, ship_code, stored


@dataclass(frozen=True)
class NearParams:
    words: int = 5
    percent: int = 75
    n_chunks: int = 10
    chunk: int = 4
    errors: int = 1
    seed: int = 11
    block_rows: int = 512
    block_shingles: int = 400_000
    whole_blocks: int = 16  # a group of more blocks is taken key by key
    bin_shingles: int = 1_000_000


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of all words together if they are fewer."""
    w = hashed_words(text)
    if not len(w):
        return w
    if len(w) < n:
        v = np.array([len(w)], dtype=np.uint64)
        for x in w:
            v = mixed(v + x)
        return v
    v = np.zeros(len(w) - n + 1, dtype=np.uint64)
    for i in range(n):
        v = v * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - n + 1 + i]
    return np.unique(mixed(v))


def signature(shingles: np.ndarray, p: NearParams) -> np.ndarray:
    rng = np.random.default_rng(p.seed)
    n = p.n_chunks * p.chunk
    flip = rng.integers(0, 2**64, n, dtype=np.uint64)[:, None]
    times = rng.integers(0, 2**63, n, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
    least = np.full(n, 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 16_384):
        least = np.minimum(least, ((shingles[None, i : i + 16_384] ^ flip) * times).min(axis=1))
    return (mixed(least) & np.uint64(0xFFFF)).astype(np.int32)


def class_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signed(p: NearParams):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                s = shingle_set(text, p.words)
                rows.append((len(s), class_key(s), signature(s, p)) if len(s) else (0, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "class", "sig"])

    return run


def _sets(p: NearParams):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t, p.words) for t in texts]
            yield pd.DataFrame({"class": [class_key(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    return run


def _keys(p: NearParams) -> Column:
    """All index keys of a signature ``sig``: each chunk without each choice of wrong values."""
    keys = []
    for c in range(p.n_chunks):
        at = range(c * p.chunk, (c + 1) * p.chunk)
        for i, kept in enumerate(combinations(at, p.chunk - p.errors)):
            keys.append(F.xxhash64(F.lit(c), F.lit(i), *[F.get("sig", F.lit(k)) for k in kept]))
    return F.explode(F.array(*keys))


def spanning_links(
    sigs: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, p: NearParams
) -> list[tuple[int, int]]:
    """A spanning forest of the links among members (between sides 0 and 1 only, if given)."""
    n = len(sets)
    near = np.zeros((n, n), dtype=bool)
    total = np.zeros((n, n), dtype=np.uint8)
    for c in range(p.n_chunks):
        equal = np.zeros((n, n), dtype=np.uint8)
        for k in range(c * p.chunk, (c + 1) * p.chunk):
            equal += sigs[:, k][:, None] == sigs[:, k][None, :]
        near |= equal >= p.chunk - p.errors
        total += equal
    size = np.array([len(s) for s in sets])
    near &= 100 * np.minimum(size[:, None], size) >= p.percent * np.maximum(size[:, None], size)
    if side is not None:
        near &= side[:, None] != side
    a, b = np.nonzero(np.triu(near, 1))
    order = np.argsort(-total[a, b].astype(np.int64), kind="stable")
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True):
        rx, ry = find(x), find(y)
        if rx == ry:
            continue
        small, large = (sets[x], sets[y]) if size[x] < size[y] else (sets[y], sets[x])
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        both = int(np.count_nonzero(large[at] == small))
        if 100 * both >= p.percent * (len(small) + len(large) - both):
            root[ry] = rx
            links.append((x, y))
    return links


def _links(p: NearParams):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for (_, i, j), group in cell.groupby(["gid", "i", "j"], sort=False):
            if len(group) > 1:
                sigs = np.vstack(group["sig"].to_numpy())
                sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
                side = (group["block"] == j).to_numpy() if i != j else None
                ids = group["class"].to_list()
                for x, y in spanning_links(sigs, sets, side, p):
                    a.append(ids[x])
                    b.append(ids[y])
        return pd.DataFrame({"a": a, "b": b}, dtype=object)

    return run


def near_duplicates(docs: DataFrame, params: NearParams) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id
    that links lead to, itself included) and kept (doc_id is component_id).

    Lower-cases A-Z; words are ``[^\\x20\\x09-\\x0D]+``. Documents whose sets have a similarity of
    percent or more are linked, confirmed on the whole sets. A null or empty text has an empty set
    and is linked with nothing. Null ids take part, but a component with any id is named by the
    smallest; a component of null ids only has a null name and all its rows are kept. Repeated rows
    are linked like any others, so rows with the id of their component are all kept. Other columns
    are ignored; an empty table gives no rows.
    """
    p = params
    ship_code(docs.sparkSession)
    signed_text = F.pandas_udf(_signed(p), "n_shingles long, class binary, sig array<int>")
    signed = stored(
        docs.select("doc_id", signed_text(F.col("text")).alias("s")).select("doc_id", "s.*"), "signed"
    )
    classes = stored(
        signed.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("sig").alias("sig"),
            F.first("n_shingles").alias("n"),
        ),
        "classes",
    )
    keyed = classes.select("class", _keys(p).alias("key"))
    heads = keyed.groupBy("key").agg(F.min("class").alias("m"), F.max("class").alias("x"))
    shared = heads.where("m <> x").select("key", "m")
    hits = stored(keyed.join(shared, "key").select("key", "class", "m"), "hits")
    groups = components(hits.select(F.col("class").alias("a"), F.col("m").alias("b")))
    links = components(_confirmed(docs, classes, hits, stored(groups, "groups"), p))
    named = classes.select("class", "least").join(
        links.withColumnsRenamed({"node": "class", "component": "c"}), "class", "left"
    )
    named = named.withColumn("c", F.coalesce("c", "class"))
    names = named.groupBy("c").agg(F.min("least").alias("component_id"))
    final = named.join(names, "c").select("class", "component_id")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(final, "class", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _confirmed(
    docs: DataFrame, classes: DataFrame, hits: DataFrame, groups: DataFrame, p: NearParams
) -> DataFrame:
    """Links (a, b) between classes, confirmed on their sets, that span all links."""
    sized = groups.withColumnsRenamed({"node": "class", "component": "gid"}).join(
        classes.select("class", "least", "sig", "n"), "class"
    )
    blocks = F.greatest(
        F.ceil(F.count("*") / p.block_rows), F.ceil(F.sum("n") / p.block_shingles)
    ).cast("int")
    counts = stored(sized.groupBy("gid").agg(blocks.alias("nb"), F.sum("n").alias("volume")), "sizes")
    whole = sized.join(counts.where(F.col("nb") <= p.whole_blocks), "gid")
    large = sized.join(counts.where(F.col("nb") > p.whole_blocks), "gid", "left_semi").drop("gid")
    by_key = large.join(hits.select("key", "class").distinct(), "class").withColumn(
        "gid", F.unhex(F.hex("key"))
    )
    key_counts = by_key.groupBy("gid").agg(blocks.alias("nb"), F.sum("n").alias("volume"))
    by_key = by_key.drop("key").join(key_counts, "gid")
    members = whole.unionByName(by_key)

    # the sets of all members are made once more from their texts
    found = F.pandas_udf(_sets(p), "class binary, shingles binary")
    wanted = whole.select("class", "least").unionByName(large.select("class", "least"))
    chosen = wanted.select(F.col("least").alias("chosen")).distinct()
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
    made = texts.select(found(F.col("text")).alias("s")).select("s.*")
    sets = stored(
        made.groupBy("class").agg(F.first("shingles").alias("shingles")).join(wanted, "class", "left_semi"),
        "sets",
    )

    bins = F.lit(
        int(counts.where("nb = 1").agg(F.coalesce(F.sum("volume"), F.lit(0))).first()[0]) // p.bin_shingles + 1
    )
    block = F.pmod(F.xxhash64("class"), F.col("nb")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    cells = (
        members.withColumn("block", block)
        .withColumn("other", other)
        .select(
            "gid",
            "class",
            "sig",
            "block",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            F.when(F.col("nb") == 1, F.pmod(F.xxhash64("gid"), bins))
            .otherwise(F.xxhash64("gid", F.least("block", "other"), F.greatest("block", "other")))
            .alias("cell"),
        )
    )
    return cells.join(sets, "class").groupBy("cell").applyInPandas(_links(p), "a binary, b binary")
