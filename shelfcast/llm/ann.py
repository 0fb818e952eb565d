"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest distance by one more component: with M the largest norm, a
vector x is indexed as (x / M, sqrt(1 - |x|^2 / M^2)) and a query q is looked up as (q / |q|, 0).
A table's bucket is the tuple of floor((a_i . x + b_i) / width) for Gaussian a_i, clipped to
``CELLS`` cells each. A query visits the ``probes`` buckets of each table in the order of their
estimated chance to hold a near neighbour: its projection is taken as normal around ``near`` times
the query's own, and the cells' chances multiply. Visited buckets are searched exactly, the tables'
candidates are merged and ranked by the exact inner product.

Buckets are shared out over cells of bounded size, so a full bucket is many tasks, and nothing in
it is left out. The parameters below are for unit vectors of 64 components without clusters, where
hashing can spare little: about nine tenths of the rows lie in visited buckets. For clustered or
many more vectors raise ``n_hashes`` and narrow ``width``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import split_cells, stored
from shelfcast.llm.vectors import classes, nearest, query_rows, usable

CELLS = 8


@dataclass(frozen=True)
class AnnParams:
    k: int = 20
    n_tables: int = 2
    n_hashes: int = 3
    width: float = 1.2
    probes: int = 24
    near: float = 0.42
    seed: int = 7
    cell_queries: int = 2048
    cell_vectors: int = 8192


@dataclass(frozen=True)
class Hashes:
    """Projections (tables, hashes, components + 1) and shifts (tables, hashes)."""

    a: np.ndarray
    b: np.ndarray
    width: float

    @staticmethod
    def draw(dim: int, p: AnnParams) -> Hashes:
        rng = np.random.default_rng(p.seed)
        a = rng.standard_normal((p.n_tables, p.n_hashes, dim + 1))
        return Hashes(a, rng.random((p.n_tables, p.n_hashes)) * p.width, p.width)

    def buckets(self, points: np.ndarray, table: int) -> np.ndarray:
        at = np.floor((points @ self.a[table].T + self.b[table]) / self.width)
        cell = np.clip(at, -CELLS // 2, CELLS // 2 - 1).astype(np.int64) + CELLS // 2
        return cell @ (CELLS ** np.arange(cell.shape[1]))

    def probes(self, points: np.ndarray, table: int, near: float, n: int) -> np.ndarray:
        """Codes of the n likeliest buckets of each point, likeliest first."""
        h = self.b.shape[1]
        projected = points @ self.a[table].T
        edges = np.arange(-CELLS // 2, CELLS // 2 + 1) * self.width
        z = edges - self.b[table][:, None] - near * projected[:, :, None]
        z = np.clip(z / np.sqrt(1 - near**2), -8, 8)
        z[:, :, 0], z[:, :, -1] = -np.inf, np.inf
        # the logistic curve stands in for the normal one
        chance = np.diff(1 / (1 + np.exp(-1.702 * z)), axis=2) + 1e-12
        cells = np.indices((CELLS,) * h).reshape(h, -1)
        codes = (CELLS ** np.arange(h)) @ cells
        total = sum(np.log(chance[:, i, :])[:, cells[i]] for i in range(h))
        return codes[np.argsort(-total, axis=1, kind="stable")[:, :n]]


def _indexed(hashes: Hashes, top_norm: float, probes: int, near: float):
    """A mapInPandas function from (class, vec) to (tab, bucket, class, vec)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in (batch.iloc[i : i + 256] for i in range(0, len(batch), 256)):
                x = np.vstack(part["vec"].to_numpy())
                if probes:
                    point = np.zeros((len(x), x.shape[1] + 1))
                    scaled = x / np.abs(x).max(axis=1, keepdims=True)
                    point[:, :-1] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                else:
                    scaled = x / top_norm
                    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1, keepdims=True)))
                    point = np.hstack([scaled, rest])
                for t in range(len(hashes.b)):
                    if probes:
                        codes = hashes.probes(point, t, near, probes)
                    else:
                        codes = hashes.buckets(point, t)[:, None]
                    rows = np.repeat(np.arange(len(part)), codes.shape[1])
                    out = part.iloc[rows].assign(tab=t, bucket=codes.ravel())
                    yield out[["tab", "bucket", "class", "vec"]]

    return run


def best_products(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """Places (in q, in x) and inner products of the k best rows of x for each row of q, equal ones
    by smaller id. Products are summed in the order of the components: a matrix product, whose
    order is its own, only finds the rows within its rounding of the k-th best."""
    n, dim = min(k, len(x)), q.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        score = q @ x.T
        border = np.partition(score, len(x) - n, axis=1)[:, len(x) - n]
        longest = np.linalg.norm(x, axis=1).max()
        slack = 4 * dim * np.finfo(np.float64).eps * np.linalg.norm(q, axis=1) * longest
        i, j = np.nonzero(~(score < (border - slack)[:, None]))
        exact = np.zeros(len(i))
        for d in range(dim):
            exact += x[j, d] * q[i, d]
    order = np.lexsort((ids[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < n], j[place < n], exact[place < n]


def _scored(k: int):
    """For a cell's vectors and queries the k best vectors of each query."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            x, ids = np.vstack(vectors["vec"].to_numpy()), vectors["class"].to_numpy()
            for start in range(0, len(queries), 256):
                part = queries.iloc[start : start + 256]
                asked = part["class"].to_numpy()
                i, j, score = best_products(np.vstack(part["vec"].to_numpy()), x, ids, k)
                out.append(pd.DataFrame({"qclass": asked[i], "class": ids[j], "score": score}))
        if not out:
            return pd.DataFrame({"qclass": pd.Series(dtype="int64"), "class": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.concat(out)

    return run


def nearest_by_hashing(vectors: DataFrame, is_query, params: AnnParams) -> DataFrame:
    """The k rows with the largest inner product found for each query row of vectors (vec_id,
    embedding): query_id, rank, vec_id, score, equal scores by smaller vec_id.

    is_query is a condition on vec_id. Rows without an id, null vectors, those with null or
    non-finite components, of zeros or of another length than most take no part. A row that repeats
    another is a candidate for it. Other columns are ignored; an empty table gives no rows.
    """
    rows = usable(vectors, zero_too=False)
    members = classes(rows, params.k)
    queries = query_rows(rows, members, is_query)
    heads = members.where("vec_id = class AND copy = 1").select("class", "vec")
    first = heads.select(F.size("vec")).first()
    dim = first[0] if first else 1
    # the largest norm, written so that no component's square overflows
    biggest = heads.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0] or 1.0
    square = heads.agg(
        F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / biggest) * (x / biggest)))
    ).first()[0]
    top_norm = biggest * float(np.sqrt(square or 1.0))
    hashes = Hashes.draw(dim, params)
    schema = "tab int, bucket long, class long, vec array<double>"
    index = heads.mapInPandas(_indexed(hashes, top_norm, 0, params.near), schema)
    asked = heads.join(queries.select("class").distinct(), "class", "left_semi").select("class", "vec")
    probes = asked.mapInPandas(_indexed(hashes, top_norm, params.probes, params.near), schema)
    left, right = split_cells(
        index, probes, ["tab", "bucket"], params.cell_vectors, params.cell_queries, "class", "class"
    )
    cell = ["tab", "bucket", "cl", "cr"]
    scored = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInPandas(
            lambda a, b: _scored(params.k + 1)(a, b), "qclass long, class long, score double"
        )
    )
    return ranked(scored, queries, members, params.k)


def ranked(scored: DataFrame, queries: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The best of each query among the candidates of all tables, which score alike in each."""
    from pyspark.sql import Window

    merged = scored.groupBy("qclass", "class").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qclass").orderBy(F.desc("score"), "class")
    best = merged.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1)
    return nearest(stored(best.drop("rn"), "nearest"), queries, members, k)
