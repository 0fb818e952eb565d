"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm.spelling import (
    GramDictionary,
    VariantParams,
    code_points,
    near_words,
    spelling_variants,
    word_counts,
)

DOCS = "doc_id long, text string, word int, Key string, n string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "a", "b") for i, t in rows], DOCS)


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def plain_words(rows, p, every=None):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= p.min_chars
    return {w: n for w, n in counts.items() if n >= p.min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, p):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= p.times * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts)


def rows_of(df):
    names = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=lambda r: r[0])


def random_words(rng, n, letters="abcé", low=7, high=10):
    words = {"".join(rng.choices(letters, k=rng.randrange(low, high))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        at = rng.randrange(len(w))
        words |= {w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + "ß" + w[at + 1 :]}
    return {w: 10 ** rng.randrange(5) + rng.randrange(3) for w in words if len(w) >= low}


@pytest.mark.parametrize(
    "params",
    [
        VariantParams(),
        VariantParams(block_rows=3, bin_rows=400),
        VariantParams(q_max=2, frequent=0.05),
        VariantParams(q_min=1, q_max=3, frequent=0.01),
        VariantParams(q_min=3, q_max=3),
    ],
)
def test_equals_all_pairs(spark, params):
    counts = random_words(random.Random(1), 90)
    assert rows_of(spelling_variants(table(spark, counts), params)) == plain_variants(counts, params)


def test_longer_grams_of_long_words(spark):
    params = VariantParams(min_chars=10, q_min=2, q_max=5, frequent=0.001, block_rows=20)
    counts = random_words(random.Random(2), 80, letters="ab", low=10, high=13)
    assert rows_of(spelling_variants(table(spark, counts), params)) == plain_variants(counts, params)


def test_pairs_come_once_and_both_ways(spark):
    counts = random_words(random.Random(3), 120, letters="ab")
    pairs = [(r.word, r.near) for r in near_words(table(spark, counts), VariantParams(bin_rows=200)).collect()]
    expected = {(a, b) for a in counts for b in counts if one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


@pytest.mark.parametrize("q", [(2, 3), (2, 5), (1, 3), (2, 2)])
def test_no_edit_changes_more_grams_than_the_bound(q):
    rng = random.Random(4)
    n = 2 * q[1]
    grams = {"".join(rng.choices("abc", k=rng.randrange(q[0] + 1, q[1] + 1))) for _ in range(40)} if q[0] < q[1] else set()
    d = GramDictionary.of(*q, {}, grams)

    def own(word):
        codes = code_points([word])
        hashes, lengths = d.decomposed(codes)
        bounds = d.changed(codes, lengths)
        return [(int(hashes[0, p]), p) for p in range(hashes.shape[1]) if lengths[0, p]], [int(b[0]) for b in bounds]

    for _ in range(100):
        word = "".join(rng.choices("abc", k=rng.randrange(n, n + 6)))
        have, (replaced, added) = own(word)
        assert len(have) > max(replaced, added)
        for at in range(len(word) + 1):
            for kind in ("replace", "delete", "add"):
                if at == len(word) and kind != "add":
                    continue
                letter = rng.choice("abcd")
                after = word[:at] + (letter if kind != "delete" else "") + word[at + (kind != "add") :]
                there, _ = own(after)
                step = {"replace": 0, "delete": -1, "add": 1}[kind]
                kept = sum((g, p) in there or (g, p + step) in there for g, p in have)
                assert len(have) - kept <= (added if kind == "add" else replaced)


def test_words_of_documents(spark):
    p = VariantParams(min_count=1)
    rows = [
        (1, "Straßenbahn STRASSENBAHN strassenbahn"), (2, None), (3, ""), (None, "nobody's paragraph paragraph"),
        (4, "ÀÉÎÕÜ×÷ÿ Àéîõü×÷ÿ short abcdefg-hijklmn abc9defghij"), (4, "repeated repeated"), (5, "x" * 30_000),
        (6, "ŁŁŁabcdefgŁ Ωabcdefg"), (7, "tab\tseparated spaces lines"),
    ]
    for every in (None, 2, 31):
        found = {r.word: r.n for r in word_counts(docs(spark, rows), p, every).collect()}
        assert found == plain_words(rows, p, every)
    small = VariantParams(min_count=2, remembered_words=1)
    found = {r.word: r.n for r in word_counts(docs(spark, rows), small).collect()}
    assert found == plain_words(rows, small)


def test_long_runs_copies_and_chains(spark):
    p = VariantParams()
    long = "ab" * 1000
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]}")] + [(2, "aaaaaaaa " * 2000)]
    rows += [(3, "chainone " * 1000), (4, "chainons " * 100), (5, "chainens " * 10), (6, "tieones tieones tieonez tieonez")]
    rows += [(10 + i, "tieonex " * 20 + "tieoney " * 20) for i in range(3)]
    counts = plain_words(rows, p)
    found = rows_of(spelling_variants(word_counts(docs(spark, rows), p), p))
    assert found == plain_variants(counts, p)
    roots = {r[0]: r[2] for r in found}
    assert roots["chainens"] == "chainone" and roots["tieones"] == "tieonex"


def test_empty_tables_and_limits(spark):
    p = VariantParams()
    assert spelling_variants(word_counts(docs(spark, []), p), p).collect() == []
    assert rows_of(spelling_variants(table(spark, {"lonely word": 3}), p)) == [("lonely word", None, "lonely word", 3, 0, None)]
    with pytest.raises(ValueError):
        VariantParams(min_chars=5)


def test_hashes_tell_grams_of_all_lengths_apart():
    d = GramDictionary.of(2, 3, {"ab": 5, "abc": 2}, {"abc"})
    assert len(np.unique(np.concatenate([d.grams, d.beginnings, d.endings]))) == 3
