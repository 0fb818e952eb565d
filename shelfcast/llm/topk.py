"""Exact top-k inner products by the three-phase uniform threshold method.

A vector's score is the sum of its partial scores over ``n_lists`` slices of the components; each
slice of each block of candidates is a list, ranked by the partial score.

1. Every list gives its k best entries for each query, with their whole scores. The k-th best whole
   score of all entries given is the query's safe cutoff: k candidates reach it.
2. The cutoffs, one row a query, go back to the lists. A candidate that reaches the cutoff has a
   partial score of cutoff / n_lists in one list at least, so each list gives the entries that
   reach this uniform threshold.
3. An entry's score is at most the sum of the partial scores given and, for the other lists, the
   threshold. Those that can reach the cutoff are resolved exactly.

Components are whole numbers of any size, so partial and whole scores are exact and no result is lost. Scores
beyond a long are given as its limit but ranked by their exact value within a block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import split_cells, stored
from shelfcast.llm.vectors import classes, nearest, query_rows, usable

SCORED = "qclass long, class long, score long"


@dataclass(frozen=True)
class TopKParams:
    k: int = 5
    n_lists: int = 2
    scale: float = 256.0
    cell_queries: int = 1024
    cell_vectors: int = 8192


def _whole(vectors: pd.Series, scale: float) -> np.ndarray:
    """floor(scale * x); Python's integers where that is beyond a float."""
    x = np.vstack(vectors.to_numpy())
    with np.errstate(over="ignore"):
        whole = np.floor(scale * x)
    over = np.isinf(whole)
    if over.any():
        whole = whole.astype(object)
        whole[over] = [math.floor(Fraction(scale) * Fraction(v)) for v in x[over].tolist()]
    return whole


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: floats where they hold every sum, Python's integers beyond."""
    fits = q.dtype != object and x.dtype != object
    if fits and np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) < 2.0**53:
        return q @ x.T
    whole = [[int(v) for v in row] for row in x.tolist()]
    asked = [[int(v) for v in row] for row in q.tolist()]
    out = np.empty((len(asked), len(whole)), dtype=object)
    for i, a in enumerate(asked):
        out[i] = [sum(p * r for p, r in zip(a, b, strict=True)) for b in whole]
    return out


def _long(values: np.ndarray) -> np.ndarray:
    if values.dtype == object:
        return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in values], dtype=np.int64)
    return values.astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest scores, equal ones by smaller id."""
    if len(score) > n:
        least = np.partition(score, len(score) - n)[len(score) - n]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:n]]


def _cell(p: TopKParams, second: bool):
    """The lists of a cell: phase 1 gives (qclass, class, score) of each list's best entries, the
    second pass the resolved entries that reach the query's cutoff."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(vectors) and len(queries):
            x, ids = _whole(vectors["vec"], p.scale), vectors["class"].to_numpy()
            slices = np.array_split(np.arange(x.shape[1]), min(p.n_lists, x.shape[1]))
            m = len(slices)
            for i in range(0, len(queries), 128):
                part = queries.iloc[i : i + 128]
                q, asked = _whole(part["vec"], p.scale), part["class"].to_numpy()
                lists = [_products(q[:, s], x[:, s]) for s in slices]
                cutoffs = part["cutoff"].to_numpy() if second else None
                for j in range(len(q)):
                    entries = [partial[j] for partial in lists]
                    if not second:
                        at = np.unique(np.concatenate([_best(e, ids, p.k + 1) for e in entries]))
                    elif pd.isna(cutoffs[j]):
                        at = np.arange(len(ids))
                    else:
                        cut = int(cutoffs[j])
                        given = [e * m >= cut for e in entries]
                        at = np.flatnonzero(np.logical_or.reduce(given))
                        bound = sum(np.where(g[at], e[at] * m, cut) for g, e in zip(given, entries, strict=True))
                        at = at[bound >= cut * m]
                    score = sum(e[at] for e in entries)
                    if second and not pd.isna(cutoffs[j]):
                        at, score = at[score >= cut], score[score >= cut]
                    best = _best(score, ids[at], p.k + 1) if second else np.arange(len(at))
                    found.append((np.full(len(best), asked[j]), ids[at[best]], _long(score[best])))
        names = ("qclass", "class", "score")
        if not found:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*found, strict=True), strict=True)})

    return run


def _pass(vectors: DataFrame, queries: DataFrame, p: TopKParams, second: bool) -> DataFrame:
    key = F.lit(0).alias("one")
    left, right = split_cells(
        vectors.select("*", key), queries.select("*", key), ["one"], p.cell_vectors, p.cell_queries, "class", "class"
    )
    run = _cell(p, second)
    return (
        left.groupBy("one", "cl", "cr")
        .cogroup(right.groupBy("one", "cl", "cr"))
        .applyInPandas(lambda a, b: run(a, b), SCORED)
    )


def exact_top_k(vectors: DataFrame, is_query, params: TopKParams) -> DataFrame:
    """The k rows with the largest inner product for each query row of vectors (vec_id, embedding),
    components taken as floor(scale * x): query_id, rank, vec_id, score, equal scores by smaller
    vec_id; all rows if there are fewer.

    is_query is a condition on vec_id. Rows without an id, null vectors, those with null or
    non-finite components or of another length than most take no part. A row that repeats another
    is a candidate for it. Other columns are ignored; an empty table gives no rows.
    """
    rows = usable(vectors, zero_too=True)
    members = classes(rows, params.k)
    queries = query_rows(rows, members, is_query)
    heads = members.where("vec_id = class AND copy = 1").select("class", "vec")
    asked = heads.join(queries.select("class").distinct(), "class", "left_semi").select("class", "vec")
    given = _pass(heads, asked, params, second=False)
    order = Window.partitionBy("qclass").orderBy(F.desc("score"), "class")
    best = given.distinct().withColumn("rn", F.row_number().over(order))
    # a score at the lower limit of a long may be lower still: no cutoff then
    sure = (F.col("rn") == params.k + 1) & (F.col("score") > F.lit(-(2**63)))
    cutoffs = best.where(sure).select(
        F.col("qclass").alias("class"), F.col("score").cast("string").alias("cutoff")
    )
    sent = asked.join(stored(cutoffs, "cutoffs"), "class", "left")
    resolved = _pass(heads, sent, params, second=True)
    top = resolved.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= params.k + 1)
    return nearest(stored(top.drop("rn"), "topk"), queries, members, params.k)
