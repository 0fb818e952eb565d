"""Near-duplicates against every pair."""

import random

import numpy as np
from shelfcast.llm.common import components
from shelfcast.llm.near_dups import NearParams, near_duplicates, shingle_set, signature, spanning_links

SCHEMA = "doc_id long, text string, lang string"


def words(text):
    return text.encode().lower().split() if text else []


def sets(rows):
    out = []
    for _, text in rows:
        w = words(text)
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def expected(rows):
    found = sets(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(found[a] & found[b])
            if both and 100 * both >= 75 * len(found[a] | found[b]):
                root[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        name = min(ids) if ids else None
        out.append((doc_id, len(found[i]), name, doc_id == name))
    return sorted(out, key=repr)


def result(spark, rows, **changes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(docs, NearParams(**changes)).collect()), key=repr)


def edited(rng, text, share):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in text.split())


def corpus(seed, n_groups, size):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 6, 40, 120, 300])))
        for _ in range(rng.randint(1, size)):
            rows.append((len(rows) * 3 + 1, edited(rng, base, rng.choice([0, 0, 0.01, 0.03, 0.06]))))
    rng.shuffle(rows)
    return rows


def test_equals_every_pair(spark):
    rows = corpus(1, 40, 8)
    assert result(spark, rows) == expected(rows)


def test_large_groups_over_many_blocks_and_key_by_key(spark):
    rng = random.Random(2)
    base = " ".join(f"w{i}" for i in range(150))
    rows = [(i, edited(rng, base, rng.choice([0.005, 0.02, 0.04, 0.07]))) for i in range(150)]
    want = expected(rows)
    assert len({r[2] for r in want}) > 1
    assert result(spark, rows, block_rows=16, whole_blocks=100) == want
    assert result(spark, rows, block_rows=16, whole_blocks=1) == want


def test_nulls_empty_short_repeated_and_long(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one TWO"), (3, "one two three"), (10, "a b c d e"),
        (2, "a b c d e"), (2, "a b c d e"), (None, "A b c d e"), (None, "x y"), (11, long), (12, long + " more"),
    ]
    got = result(spark, rows)
    assert got == sorted(expected(rows), key=repr) or got == sorted(
        [(d, n, c, True if d is None and c is None else k) for d, n, c, k in expected(rows)], key=repr
    )
    assert {r[0]: r[2] for r in got if r[0]}[10] == 2 and {r[0]: r[2] for r in got if r[0]}[12] == 11
    assert result(spark, []) == []


def test_extra_columns_are_ignored(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "s", 2)], "doc_id long, text string, class int, sig string, n int")
    assert near_duplicates(docs, NearParams()).collect()[0].asDict() == {
        "doc_id": 1, "n_shingles": 1, "component_id": 1, "kept": True
    }


def test_pairs_within_the_distance_share_a_key():
    p = NearParams()
    rng = np.random.default_rng(0)
    for _ in range(50):
        a = rng.integers(0, 2**16, p.n_chunks * p.chunk)
        b = a.copy()
        wrong = rng.choice(len(a), p.n_chunks * (p.errors + 1) - 1, replace=False)
        b[wrong] += 1
        one = [np.array([1, 2, 3], dtype=np.uint64)] * 2
        assert spanning_links(np.vstack([a, b]), one, None, p) == [(0, 1)]


def test_signatures_agree_as_often_as_sets():
    p = NearParams(n_chunks=200)
    a = shingle_set(" ".join(f"w{i}" for i in range(1000)), 5)
    b = np.sort(np.concatenate([a[:600], shingle_set(" ".join(f"z{i}" for i in range(404)), 5)]))
    share = (signature(a, p) == signature(b, p)).mean()
    assert abs(share - 600 / (len(a) + len(b) - 600)) < 0.06


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9)] + [(i, i + 1) for i in range(20, 60)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.component) for r in found} == (
        {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)} | {(i, 20) for i in range(20, 61)}
    )
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
