"""Centroid clustering with Ns-bounds, exact on whole numbers.

Every vector keeps, for each centroid, the distance found when the pair was last evaluated and the
round of that evaluation. The centroids of all rounds are kept too, so a stored distance is loosened
by the norm of the centroid's total displacement since that round, which is at most, and mostly far
less than, the sum of the displacements of the rounds between. A vector whose own distance, loosened
upwards, stays below all others, loosened downwards, keeps its cluster unseen. Otherwise its own
distance is evaluated again, and the centroids whose bounds still fail are evaluated exactly.

Components are whole numbers floor(scale * x) and centroids are componentwise floors of exact means,
so squared distances are whole numbers and ties are real ties: the smaller number wins. Bounds only
decide what is evaluated; they carry a margin for the rounding of square roots.

A round is one pass of tasks over their own vectors and their state, and one aggregate of at most k
rows of sums; vectors never move between tasks. The driver holds centroids only: k of them for each
of ``rounds + 1`` rounds. The state after each round is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship_code, stored

#: Larger components are taken as this.
LARGEST = 2**62
LONG = 2**63 - 1
#: Relative margin of bounds, well above the rounding of doubles.
MARGIN = 1e-9


@dataclass(frozen=True)
class MeansParams:
    k: int = 16
    dim: int = 64
    rounds: int = 3
    scale: float = 64.0
    seed: int = 1


def whole_vectors(vectors: DataFrame, p: MeansParams) -> DataFrame:
    """Rows (vec_id, q array<long>) of the vectors that take part."""
    vec = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = float(LARGEST)

    def whole(x: Column) -> Column:
        scaled = x * F.lit(p.scale)
        return F.floor(F.greatest(F.least(scaled, F.lit(limit)), F.lit(-limit))).cast("long")

    kept = vec.where(F.col("vec_id").isNotNull() & (F.size("v") == p.dim) & finite)
    return kept.select("vec_id", F.transform("v", whole).alias("q"))


def first_centroids(rows: DataFrame, p: MeansParams) -> list[list[int]]:
    """The k vectors with the smallest hash of seed and id; repeated ids by their components."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(p.seed)), F.col("vec_id").cast("string")), 256)
    drawn = rows.select(digest.alias("h"), "q").orderBy("h", "q").limit(p.k).collect()
    return [list(row.q) for row in drawn]


def _small(x: np.ndarray, history: list[list[list[int]]]) -> bool:
    """Whether squared distances and the products behind them are exact in doubles."""
    top = max(int(np.abs(x).max(initial=0)), max(abs(v) for c in history[-1] for v in c))
    return top < LARGEST // 4 and 4 * top * top * x.shape[1] < 2**53


def squared(x: np.ndarray, centroid: list[int], small: bool) -> np.ndarray:
    """Exact squared distances of the rows of x, as int64 or as Python's integers."""
    if small:
        d = x - np.array(centroid, dtype=np.int64)
        return np.einsum("ij,ij->i", d, d)
    out = np.empty(len(x), dtype=object)
    for i, row in enumerate(x.tolist()):
        out[i] = sum((a - b) ** 2 for a, b in zip(row, centroid, strict=True))
    return out


def _norms(a: list[list[int]], b: list[list[int]]) -> list[float]:
    """Distance of each centroid of a to its place in b, rounded up."""
    return [
        float(sum((x - y) ** 2 for x, y in zip(c, d, strict=True))) ** 0.5 * (1 + MARGIN)
        for c, d in zip(a, b, strict=True)
    ]


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Round:
    """One assignment of vectors to the last centroids of the history."""

    def __init__(self, history: list[list[list[int]]]):
        self.history = history
        self.now = len(history) - 1
        self.moved = np.array([_norms(h, history[-1]) for h in history])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        centroids, small = self.history[-1], _small(x, self.history)
        d = np.column_stack([squared(x, c, small) for c in centroids])
        own = np.array([int(np.argmin(row)) for row in d]) if d.dtype == object else d.argmin(axis=1)
        seen = np.full(d.shape, self.now, dtype=np.int64)
        return own, d[np.arange(len(x)), own], _root(d), seen, np.full(len(x), len(centroids))

    def again(self, x: np.ndarray, own: np.ndarray, dist: np.ndarray, seen: np.ndarray):
        """cluster, exact squared distance (None where not evaluated), dist, seen, evaluations."""
        centroids, small = self.history[-1], _small(x, self.history)
        n, k = dist.shape
        every, numbers = np.arange(n), np.arange(k)
        drift = self.moved[seen, numbers[None, :]]
        lower = dist * (1 - MARGIN) - drift
        upper = dist[every, own] * (1 + MARGIN) + drift[every, own]
        other = numbers[None, :] != own[:, None]
        evaluated = np.zeros(n, dtype=np.int64)
        exact: np.ndarray = np.full(n, None, dtype=object)

        def evaluate(rows: np.ndarray, j: int) -> np.ndarray:
            d = squared(x[rows], centroids[j], small)
            dist[rows, j], seen[rows, j] = _root(d), self.now
            evaluated[rows] += 1
            return d

        failing = np.flatnonzero((other & (lower <= upper[:, None])).any(axis=1))
        for j in np.unique(own[failing]):
            rows = failing[own[failing] == j]
            exact[rows] = evaluate(rows, int(j))
        upper[failing] = dist[failing, own[failing]] * (1 + MARGIN)
        fails = other[failing] & (lower[failing] <= upper[failing, None])
        best, least = own.copy(), exact.copy()
        for j in range(k):
            rows = failing[fails[:, j]]
            if len(rows):
                d = evaluate(rows, j).astype(object)
                closer = (d < least[rows]) | ((d == least[rows]) & (j < best[rows]))
                best[rows[closer]], least[rows[closer]] = j, d[closer]
        return best, least, dist, seen, evaluated

    def final(self, x: np.ndarray, cluster: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Exact squared distances to the own centroid, at most the largest long."""
        small = _small(x, self.history)
        for j in np.unique(cluster):
            rows = np.flatnonzero((cluster == j) & (least == None))  # noqa: E711
            least[rows] = squared(x[rows], self.history[-1][int(j)], small)
        return np.array([min(int(v), LONG) for v in least], dtype=np.int64)


STATE = "vec_id long, q array<long>, cluster int, dist array<double>, seen array<int>, evaluated long"
RESULT = "vec_id long, cluster int, distance long, evaluated long"


def _pass(history: list[list[list[int]]], last: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = Round(history)
        for rows in batches:
            if not len(rows):
                continue
            x = np.vstack(rows["q"].to_numpy()).astype(np.int64)
            before = np.zeros(len(rows), dtype=np.int64)
            if "cluster" in rows:
                before = rows["evaluated"].to_numpy()
                dist = np.vstack(rows["dist"].to_numpy()).copy()
                seen = np.vstack(rows["seen"].to_numpy()).astype(np.int64)
                own = rows["cluster"].to_numpy().astype(np.int64)
                own, least, dist, seen, evaluated = step.again(x, own, dist, seen)
            else:
                own, least, dist, seen, evaluated = step.first(x)
                least = least.astype(object)
            out = {"vec_id": rows["vec_id"], "cluster": own, "evaluated": before + evaluated}
            if last:
                out["distance"] = step.final(x, own, least)
                yield pd.DataFrame(out)[["vec_id", "cluster", "distance", "evaluated"]]
            else:
                out |= {"q": rows["q"], "dist": list(dist), "seen": list(seen)}
                yield pd.DataFrame(out)[["vec_id", "q", "cluster", "dist", "seen", "evaluated"]]

    return run


def _means(state: DataFrame, before: list[list[int]], p: MeansParams) -> list[list[int]]:
    """Componentwise floors of the exact means; an empty cluster keeps its centroid."""
    sums = [F.sum(F.col("q")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(p.dim)]
    after = [list(c) for c in before]
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(p.dim)]
    return after


def cluster_vectors(vectors: DataFrame, params: MeansParams) -> DataFrame:
    """One row for each vector of (vec_id, embedding) that takes part: vec_id, cluster, distance
    (squared, to its final centroid), cluster_inertia, inertia, centroid_sha256, evaluated (how many
    exact distances its assignments took).

    Rows without an id, null vectors, vectors of another length and those with null or non-finite
    components take no part. Repeated rows and copies are vectors of their own. With fewer than k
    vectors there are as many clusters; equal first centroids leave the later ones empty. Components
    beyond 2**62 are taken as that, distances and inertias beyond a long as its limit. Other columns
    are ignored; an empty table gives no rows.
    """
    ship_code(vectors.sparkSession)
    rows = whole_vectors(vectors, params)
    history = [first_centroids(rows, params)]
    if not history[0]:
        none = rows.select("vec_id").limit(0)
        return none.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
            "'' AS centroid_sha256", "0L AS evaluated",
        )
    state = rows
    for _ in range(params.rounds):
        state = stored(state.mapInPandas(_pass(list(history), last=False), STATE), "means")
        history.append(_means(state, history[-1], params))
    found = stored(state.mapInPandas(_pass(list(history), last=True), RESULT), "means")

    limit = F.lit(LONG).cast("decimal(38,0)")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()
    total = sum(int(row.d) for row in sums)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1]]
    told = vectors.sparkSession.createDataFrame(
        [(row.cluster, row.d, digests[row.cluster]) for row in sums],
        "cluster int, d decimal(38,0), centroid_sha256 string",
    )
    return found.join(F.broadcast(told), "cluster").select(  # k rows
        "vec_id",
        "cluster",
        "distance",
        F.least("d", limit).cast("long").alias("cluster_inertia"),
        F.lit(min(total, LONG)).cast("long").alias("inertia"),
        "centroid_sha256",
        "evaluated",
    )
