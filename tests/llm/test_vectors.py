"""Both vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm.ann import AnnParams, best_products, nearest_by_hashing
from shelfcast.llm.topk import TopKParams, exact_top_k

SCHEMA = "vec_id long, embedding array<double>, class string, vec int"


def is_query():
    return F.col("vec_id") % 5 == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1) for i, v in rows], SCHEMA)


def best(rows, k, whole):
    """(query_id, rank, vec_id, score), each row a candidate for all others."""
    usable = [
        (i, np.floor(256 * np.array(v)) if whole else np.array(v))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(usable):
        if i % 5:
            continue
        scored = sorted((-float(q @ v), j) for b, (j, v) in enumerate(usable) if b != a)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, float(r.score)) for r in df.collect())


def odd_rows(rng):
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(40)]  # copies of one vector, queries among them
    rows += [(200, None), (201, [float("nan")] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, rows[0][1])]
    rows += [(205, [float("inf")] * 6), (210, rows[3][1]), (210, rows[3][1]), (215, [])]
    return rows


def test_top_k_equals_brute_force(spark):
    rows = odd_rows(np.random.default_rng(1))
    for params in (TopKParams(), TopKParams(n_lists=4, cell_vectors=16, cell_queries=4), TopKParams(k=200)):
        assert rows_of(exact_top_k(frame(spark, rows), is_query(), params)) == best(rows, params.k, True)


def test_top_k_with_ties_negatives_and_other_lengths(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(80)]
    expected = best(rows, 5, True)
    assert rows_of(exact_top_k(frame(spark, [*rows, (300, [1.0])]), is_query(), TopKParams())) == expected
    negative = [(i, [-1.0 - i if i else 1.0, 0.0]) for i in range(30)]
    assert rows_of(exact_top_k(frame(spark, negative), is_query(), TopKParams())) == best(negative, 5, True)


def test_top_k_of_very_large_components(spark):
    rows = [(i, [2e5 * (i + 1) ** 2, 7.0]) for i in range(8)]
    found = exact_top_k(frame(spark, rows), is_query(), TopKParams(k=2)).collect()
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    for r in found:
        assert r.score == sum(a * b for a, b in zip(whole[r.query_id], whole[r.vec_id], strict=True))


def test_top_k_of_components_beyond_a_float(spark):
    huge = 1.5e308  # 256 times it is infinite
    rows = [(0, [huge, 1.0]), (1, [-huge, 2.0]), (2, [huge, -3.0]), (3, [0.0, 4.0]), (4, [1.0, 0.0])]
    found = exact_top_k(frame(spark, rows), is_query(), TopKParams(k=4)).collect()
    limit = 2**63
    expected = [(0, 1, 2, limit - 1), (0, 2, 4, limit - 1), (0, 3, 3, 256 * 1024), (0, 4, 1, -limit)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected


def test_products_are_ranked_by_sums_in_order():
    """Grids of components that make many sums differ by their order alone."""
    rng = np.random.default_rng(8)
    x, q = rng.integers(-3, 4, (400, 24)) / 10, rng.integers(-3, 4, (30, 24)) / 10
    x[:, 12:] = rng.permuted(x[:, :12], axis=1)
    ids = rng.permutation(400)
    for k in (1, 21, 500):
        i, j, score = best_products(q, x, ids, k)
        expected = []
        for a in range(len(q)):
            sums = [float(np.add.accumulate(q[a] * row)[-1]) for row in x]
            best_of = sorted(range(len(x)), key=lambda b: (-sums[b], ids[b]))[:k]
            expected += [(a, b, sums[b]) for b in best_of]
        assert list(zip(i, j, score, strict=True)) == expected
    huge = np.array([[1e200, 1e200], [1.0, -1e200]])
    assert len(best_products(huge, huge, np.array([1, 2]), 2)[0]) == 4


@pytest.mark.parametrize("search", [exact_top_k, nearest_by_hashing])
def test_empty_and_single(spark, search):
    params = TopKParams() if search is exact_top_k else AnnParams()
    assert search(frame(spark, []), is_query(), params).collect() == []
    assert search(frame(spark, [(5, [1.0, 2.0])]), is_query(), params).collect() == []
    two = search(frame(spark, [(5, [1.0, 2.0]), (6, [1.0, 2.0])]), is_query(), params).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in two] == [(5, 1, 6)]


def recall(spark, rows, params):
    found = nearest_by_hashing(frame(spark, rows), is_query(), params)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = {}
    for q, n, j, s in best(rows, params.k, False):
        want.setdefault(q, {})[n] = (j, s)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q].values()}) for q in want)
    vectors = dict(rows)
    for q, ranks in got.items():
        order = [(-ranks[n][1], ranks[n][0]) for n in sorted(ranks)]
        assert order == sorted(order) and sorted(ranks) == list(range(1, len(ranks) + 1))
        for j, s in ranks.values():
            assert s == pytest.approx(float(np.dot(vectors[q], vectors[j])), rel=1e-12)
    return hits / sum(map(len, want.values()))


def test_recall_on_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert recall(spark, list(enumerate(unit.tolist())), AnnParams()) >= 0.9
    spread = unit * rng.uniform(0.5, 2, 600)[:, None]
    assert recall(spark, list(enumerate(spread.tolist())), AnnParams(cell_vectors=50, cell_queries=20)) >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, v) for i, v in odd_rows(np.random.default_rng(4)) if i != 210]
    params = AnnParams(k=8, probes=512)  # every bucket: all candidates
    usable = [(i, v) for i, v in rows if v and any(v)]
    got = rows_of(nearest_by_hashing(frame(spark, [*rows, (220, [0.0] * 6)]), is_query(), params))
    want = best(usable, 8, False)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want])
