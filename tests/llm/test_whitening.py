import math
import random

import numpy as np
import pytest

from meterlake.llm import whitening
from meterlake.llm.catalog import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def usable(rows):
    return [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]


def brute(rows, k=8):
    """n, exact deviations, whitened by a full eigendecomposition, explained shares."""
    rows = usable(rows)
    x = [[math.floor(1024.0 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    d = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(d.T @ d / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, deviations, d @ vectors / np.sqrt(values), values / (d * d).sum() * n


def check(df, rows, k=8, close=1e-8):
    n, deviations, w, explained = brute(rows, k)
    ids = [i for i, _ in usable(rows)]
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert r["n"] == n and r["identity_error"] <= 1e-10 and r["deviation_exact"] == r["deviation"]
    assert sum(map(len, got.values())) == len(ids) * w.shape[1]
    for c in range(w.shape[1]):
        mine = np.array([got[i, c + 1][0]["whitened"] for i in ids])
        sign = np.sign(mine @ w[:, c])
        assert np.abs(mine * sign - w[:, c]).max() < close
        assert all(abs(got[i, c + 1][0]["explained"] / explained[c] - 1) < 1e-9 for i in ids)
    assert {i: got[i, 1][0]["deviation"] for i in ids} == dict(zip(ids, deviations))


def given(spark, d):
    return [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]


def test_given_vectors_against_a_full_decomposition(spark):
    d = "/root/testdata/sf0.001"
    check(QUERIES["op11_chebyshev_whitening"](spark, d), given(spark, d))


def test_odd_rows(spark):
    """Null and empty vectors, null, NaN and infinite entries, repeated rows, clashing columns."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(20)]) for i in range(300)]
    rows += [(1, rows[1][1])] * 50 + [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [1.0] * 19 + [float("inf")])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA + ", n int, whitened string").repartition(7)
    check(whitening.whiten(df), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.collect() == [] and got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components(spark):
    rng = random.Random(4)
    rows = [(i, [a := rng.gauss(0, 3), rng.gauss(0, 1), 2.5, a]) for i in range(200)]  # two of four dimensions vary
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert {r["component"] for r in got.collect()} == {1, 2}
    assert got.first()["identity_error"] < 1e-10


def test_unequal_widths_and_huge_entries_raise(spark):
    with pytest.raises(Exception, match="unequal width"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA).repartition(2))
    with pytest.raises(Exception, match="not exact"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 1.0]), (2, [1.0, 2.0])], SCHEMA))


def test_deviations_beyond_64_bits_are_exact():
    x = np.array([[10 ** 12, -5], [3, 7]])
    m = whitening.Moments(10 ** 9, [123, -456])
    assert m.deviations(x) == [sum((10 ** 9 * int(c) - s) ** 2 for c, s in zip(v, (123, -456))) for v in x]


def test_filter_finds_close_eigenvalues_and_counts_passes():
    """A flat spectrum, two equal eigenvalues at the top and one just below the last wanted."""
    rng = np.random.default_rng(1)
    values = np.concatenate([[50, 50, 30], np.linspace(20.05, 20, 8), np.linspace(19, 10, 109)])
    basis = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    v = (basis * values) @ basis.T
    passes = []

    def apply(q):
        passes.append(q.shape)
        return v @ q, float(np.trace(v))

    found, vectors, trace = whitening.top_eigenpairs(apply, 120, 8)
    assert np.abs(found - values[:8]).max() < 1e-11 and np.abs(v @ vectors - vectors * found).max() < 1e-11
    assert len(passes) < 200 and all(s == (120, 32) for s in passes)


def test_partial_sums_are_added_in_steps(spark):
    """More tasks than one adder takes: the sums go through a second level."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1 + j / 3) for j in range(12)]) for i in range(400)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(whitening.FAN + 9)), rows)
