import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterlake.llm import hamming, shards
from tests.llm.conftest import with_clashes


def test_shards(odd_docs, odd_rows, no_docs):
    rows = shards.shard_documents(odd_docs).collect()
    texts = {}
    for i, t, *_ in odd_rows:
        texts.setdefault(i, []).append(((len((t or "").encode()) + 1), zlib.crc32((t or "").encode())))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, *x) for i, xs in texts.items() for x in xs)
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    of = {}
    for r in rows:
        assert of.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert shards.shard_documents(no_docs).count() == 0


def test_weights_and_growth(spark):
    keys = spark.range(40_000)
    count = lambda w: {r["s"]: r["count"] for r in keys.select(shards.rendezvous(F.col("id"), w).alias("s")).groupBy("s").count().collect()}
    assert all(abs(n - 5000) < 400 for n in count([1] * 8).values())
    share = count([1, 3])
    assert abs(share[1] - 30_000) < 700
    moved = keys.select(shards.rendezvous(F.col("id"), [1] * 8).alias("a"), shards.rendezvous(F.col("id"), [1] * 9).alias("b")).filter("a <> b")
    assert {r["b"] for r in moved.select("b").distinct().collect()} == {8} and abs(moved.count() - 40_000 / 9) < 400
    with pytest.raises(ValueError):
        shards.rendezvous(F.col("id"), [1, 0])


def test_slots_of_a_hot_shard_are_spread(spark, monkeypatch):
    rows = shards.assign(with_clashes(spark.createDataFrame([(1, "a")] * 500, "doc_id long, text string")).drop("shard", "slot"),
                         "doc_id", [1.0, 1.0], ["text"], rows_per_bucket=10)
    assert sorted(r["slot"] for r in rows.select("slot").collect()) == list(range(500))


def by_force(vectors, k, dims):
    code = {i: [x is not None and x > 0 for x in (v + [None] * dims)[:dims]] for i, v in vectors if v is not None}
    out = []
    for q in code:
        if q % 5 == 0:
            near = sorted((sum(a != b for a, b in zip(code[q], c)), i) for i, c in code.items())[:k]
            out += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims, n", [(64, 150), (20, 100), (100, 60), (8, 4)])
def test_top_k(spark, dims, n):
    rng = random.Random(dims)
    same = [rng.uniform(-1, 1) for _ in range(dims)]
    vectors = [(i, same if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(dims)]) for i in range(n)]
    vectors += [(n, None), (n + 1, []), (n + 2, [None] * dims), (n + 5, [0.0] * dims)]
    table = with_clashes(spark.createDataFrame(vectors, "id long, v array<double>"))
    codes = table.select("id", hamming.sign_bits(F.col("v"), dims).alias("code"), "n", "row", "key")
    got = hamming.top_k(codes, codes.filter("id % 5 = 0"), dims, 7)
    assert sorted(map(tuple, got.collect())) == by_force(vectors, 7, dims)


def test_empty_table(spark):
    assert hamming.search_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("n", [1000, 6000])
def test_top_k_by_number_of_codes(spark, n):
    rng = random.Random(n)
    values = [rng.getrandbits(40) for _ in range(n)]
    vectors = [(i, [1.0 if v >> b & 1 else -1.0 for b in range(40)]) for i, v in enumerate(values)]
    got = hamming.search_embeddings(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), every=n // 10, k=5)
    want = [(q, rank, i, d) for q in range(0, n, n // 10)
            for rank, (d, i) in enumerate(sorted(((v ^ values[q]).bit_count(), i) for i, v in enumerate(values))[:5], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_widths_and_odd_values(spark):
    nan = float("nan")
    vectors = [(0, [1.0] * 70), (1, [1.0] * 64), (2, [nan] * 70), (3, None), (4, [])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["id"]): r["hamming"] for r in hamming.search_embeddings(table, every=1, k=4).collect()}
    assert got[0, 1] == 6 and got[0, 2] == 0 and got[0, 4] == 70 and not any(3 in pair for pair in got)
    with pytest.raises(ValueError):
        hamming.search_embeddings(table, dims=64)


def test_segments_follow_the_work_and_not_the_width_alone():
    counts = [hamming.segment_count(n, 64) for n in (2, 100, 2_000, 10_256, 51_282, 10**6, 10**7, 10**9)]
    assert counts == sorted(counts, reverse=True) and counts[-1] >= 1
    # four segments of 16 bits took 1,820 probes each at radius 4; five reach as far at radius 3
    assert hamming.segment_count(51_282, 64) == 5


def test_bounded_probes_lose_no_neighbour(spark):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(20)]
    codes = [rng.getrandbits(64) if i % 3 else rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for i in range(1500)]
    signed = [(i, [c - (1 << 64) if c >> 63 else c]) for i, c in enumerate(codes)]
    table = spark.createDataFrame(signed, "id long, code array<long>")
    got = {}
    for r in hamming.top_k(table, table.filter("id % 20 = 0"), 64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["hamming"], r["id"]))
    for q in range(0, 1500, 20):
        near = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes))[:10]
        assert sorted(got[q]) == [(n, d, i) for n, (d, i) in enumerate(near, 1)]
