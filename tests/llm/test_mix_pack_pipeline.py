"""Mixing, packing, the pipeline and the registered queries."""

import random
from collections import Counter
from itertools import combinations

import __spark_entry__ as entry_point
import corpus_pipeline
import duckdb
import pytest
from conftest import SMALL, explained

from checks.compare import differences, duck
from shelfcast.llm.common import stored
from shelfcast.llm.mixing import mix_slots, root_weights, schedule
from shelfcast.llm.packing import PackingParams, bucket_lengths, pack, written_order
from shelfcast.llm.queries import REGISTERED, oracle_sql

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("weights", [[50, 25, 13, 1, 7], [1, 1, 1], [3], [97, 2, 1], [5, 4, 3, 2, 1, 1]])
def test_schedule_stays_within_one_block(spark, weights):
    rows = [(f"s{i}", w) for i, w in enumerate(weights)]
    found = schedule(spark.createDataFrame(rows, "source string, weight long")).collect()
    total, done = sum(weights), Counter()
    assert [r.slot for r in sorted(found, key=lambda r: r.slot)] == list(range(total))
    for r in sorted(found, key=lambda r: r.slot):
        assert r.turn == done[r.key]
        assert r.turn * total // r.weight <= r.slot < -((-(r.turn + 1) * total) // r.weight)
        done[r.key] += 1
        for source, w in rows:
            assert abs(done["=" + source] - (r.slot + 1) * w / total) < 1


def test_mix_keeps_all_rows_and_shares(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "b", None, ""]), i) for i in range(900)] + [(None, "a", 1)] * 3 + [(5, "a", 2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, key int")
    weights = spark.createDataFrame([("a", 5), ("b", 2)], "source string, weight long")
    found = mix_slots(docs, weights, 4).collect()
    assert Counter((r.doc_id, r.source, r.key) for r in found) == Counter(rows)
    assert len({r.mixed.position for r in found}) == len(rows)
    assert {(r.source, r.mixed.weight) for r in found} == {("a", 5), ("b", 2), (None, 1), ("", 1)}
    per_slot = Counter((r.source, r.mixed.slot) for r in found)
    assert max(per_slot.values()) == 4 and len({s for _, s in per_slot}) == len(per_slot)
    assert mix_slots(docs.limit(0), root_weights(docs.limit(0)), 4).count() == 0


def test_weights_follow_square_roots_with_many_small_sources(spark):
    rows = [(f"s{i}",) for i in range(40)] + [("large",)] * 400
    docs = spark.createDataFrame(rows, "source string")
    found = {r.source: r.weight for r in root_weights(docs, 10).collect()}
    assert found == {**{f"s{i}": 1 for i in range(40)}, "large": 20}
    two = docs.where("source in ('s1', 'large')")
    assert sorted(r.weight for r in root_weights(two, 20).collect()) == [1, 20]
    assert sorted(r.weight for r in root_weights(two, 42).collect()) == [2, 40]


def test_weights_and_schedule_of_many_sources_equal_the_sql(spark, tmp_path):
    """More sources than parts: the smallest is neither rounded up nor the others down."""
    rng = random.Random(9)
    sources = [f"s{i:04}" for i in range(1200)] + [None, ""]
    rows = [(i, s) for i, s in enumerate(sources + rng.choices(sources, k=800) + ["s0000"] * 900)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, source string").coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    found = REGISTERED["op6_source_mixing"](spark, str(tmp_path))
    assert differences(found, connection, oracle_sql()["op6_source_mixing"]) == ""
    weights = {r.source: r.weight for r in found.select("source", "weight").distinct().collect()}
    assert min(weights.values()) == 1 and weights["s0000"] > 25


def test_mix_runs_on_dataframe_functions(spark):
    plan = explained(REGISTERED["op6_source_mixing"](spark, SMALL))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_buckets_have_the_least_padding():
    rng = random.Random(2)
    for _ in range(200):
        histogram = [(s, rng.randint(1, 9)) for s in rng.sample(range(1, 30), rng.randint(1, 7))]
        k, sizes = rng.randint(1, 4), sorted(s for s, _ in histogram)

        def padding(bounds, histogram=histogram):
            return sum(n * (min(b for b in bounds if b >= s) - s) for s, n in histogram)

        found = bucket_lengths(histogram, k)
        choices = (set(c) | {sizes[-1]} for r in range(min(k, len(sizes))) for c in combinations(sizes, r))
        assert len(found) <= k and padding(found) == min(map(padding, choices))
    assert bucket_lengths([], 3) == []


def check_batches(rows, lengths, params):
    """Each document whole, in pieces; batches full but the last of a bucket, within the budget."""
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.piece_start, r.piece_len))
        assert 0 < r.piece_len <= r.bucket_len
    for doc_id, n in lengths.items():
        at = 0
        for _, start, size in sorted(pieces[doc_id]):
            assert start == at
            at += size
        assert at == n
    batches = Counter((r.bucket, r.batch) for r in rows)
    assert len({(r.bucket, r.batch, r.place) for r in rows}) == len(rows)
    for (bucket, batch), n in batches.items():
        size = next(r.bucket_len for r in rows if r.bucket == bucket)
        room = max(1, params.batch_tokens // size)
        assert n == room or (n < room and (bucket, batch + 1) not in batches)


def test_pack_pieces_and_batches(spark):
    rng = random.Random(3)
    lengths = {i: rng.choice([1, 2, 9, 40, 41, 99, 100, 101, 350]) for i in range(400)}
    docs = spark.createDataFrame([(i, "w " * (n - 1), 1) for i, n in lengths.items()], "doc_id long, text string, slice int")
    params = PackingParams(max_len=100, n_buckets=4, batch_tokens=500, slices=8)
    check_batches(pack(docs, params).collect(), lengths, params)
    in_order = stored(docs.coalesce(1), "ordered")
    rows = pack(in_order, params, stored_order=True).collect()
    check_batches(rows, lengths, params)
    for bucket in {r.bucket for r in rows}:
        order = sorted((r.batch, r.place, r.doc_id) for r in rows if r.bucket == bucket)
        assert [o[2] for o in order] == sorted(o[2] for o in order)


def test_files_are_ordered_by_number(spark):
    names = ["part-99999-u-c000.zstd.parquet", "part-100000-u-c000.zstd.parquet"]
    names += ["part-100000-u-c999.zstd.parquet", "part-100000-u-c1000.zstd.parquet"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    assert [r.name for r in df.orderBy(*written_order(df["name"])).collect()] == names


def test_pack_nulls_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c")], "doc_id long, text string")
    rows = pack(docs, PackingParams()).collect()
    assert sorted((r.doc_id or 0, r.piece_len) for r in rows) == [(0, 2), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert pack(docs.limit(0), PackingParams()).count() == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with toxic ones, a passage of 60 words in three, exact and near copies."""
    rng = random.Random(4)

    def prose(n):
        return " ".join(("w%d%s" % (rng.randint(0, 5000), "." if rng.random() < 0.1 else "")) for _ in range(n))

    passage = "Start. " + " ".join(f"p{i}" for i in range(60)) + ". "
    rows, labels = [], []
    for i in range(120):
        toxic = i % 6 == 0
        rows.append((i, prose(80) + (" scummy idiot scum trash" if toxic else ""), "en", f"s{i % 3}", 1))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(200 + i, passage + prose(90), "en", "s0", 1) for i in range(3)]
    near = [f"n{j}" for j in range(45)]
    rows += [(300 + i, " ".join(near[:40] + [f"e{i}"] + near[40:]), "en", "s1", 1) for i in range(4)]
    rows += [(400, rows[1][1], "de", "s2", 1), (401, "", "de", None, 0), (402, None, None, "s1", None)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCUMENT).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").withColumnRenamed("lang", "rank")
    names = docs.columns
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, corpus), name)
        at[name] = docs
        if name != "packing":
            assert docs.columns == names
    ids = {n: {r.doc_id for r in at[n].collect()} for n in at}
    first = set(range(120)) | {200, 201, 202, 300, 301, 302, 303, 400, 401, 402}
    assert ids["toxicity"] == {i for i in first if i >= 120 or i % 6}
    assert ids["line_dedup"] == ids["toxicity"] - {400}
    texts = {r.doc_id: r for r in at["line_dedup"].collect()}
    assert [("p30" in texts[i].text) for i in (200, 201, 202)] == [True, False, False]
    assert texts[201].n_chars == len(texts[201].text) and texts[1].n_chars == 1
    assert ids["near_duplicates"] == ids["line_dedup"] - {301, 302, 303}
    assert ids["mixing"] == ids["packing"] == ids["near_duplicates"]


def test_stages_on_an_empty_table(spark, corpus):
    docs = spark.createDataFrame([], DOCUMENT)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, corpus), name)
        assert docs.count() == 0


def test_run(spark, corpus):
    found = corpus_pipeline.run(spark, corpus)
    assert found.count() == 106 and found.columns[0] == "doc_id"


@pytest.mark.parametrize("name", oracle_sql())
def test_query_matches_sql(spark, name):
    assert differences(REGISTERED[name](spark, SMALL), duck(SMALL), oracle_sql()[name]) == ""


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in REGISTERED)
    assert numbers == list(range(1, 14))
    assert REGISTERED.keys() | {"pipeline"} <= entry_point.queries().keys()
