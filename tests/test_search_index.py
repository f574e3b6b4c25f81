"""Substring search by grams against a plain scan."""

import random

import pytest

from meterlake.operators import search_index as S

KEYS = ["kind", "id"]


@pytest.fixture(scope="module")
def indexed(spark):
    from meterlake.session import fresh_dir
    rng = random.Random(1)
    names = ["".join(rng.choice("abAB_1é") for _ in range(rng.randint(1, 9))) for _ in range(400)] + ["aaa", "Table_001", "tabletable", "", None, "x", "x"]
    rows = [("JOB" if i % 2 else None, i, n) for i, n in enumerate(names)]
    path = fresh_dir(spark, "index")
    S.build(spark.createDataFrame(rows, "kind string, id long, name string"), KEYS, path)
    return path, rows


@pytest.mark.parametrize("needle", ["a", "É", "x", "AB", "__", "bab", "aaa", "table", "Table_0", "tablet", "ab_1", "zzz", "abz", "", "q"])
def test_search_equals_a_scan(spark, indexed, needle):
    path, rows = indexed
    got = sorted((r.id, r.name) for r in S.search(spark, path, needle, KEYS).collect())
    assert got == sorted((i, n) for _, i, n in rows if n is not None and needle.lower() in n.lower())


def test_every_needle_of_the_names(spark, indexed):
    path, rows = indexed
    for name in ("Table_001", "tabletable"):
        for length in (1, 2, 3, 4, 6):
            needle = name[2:2 + length]
            assert name in {r.name for r in S.search(spark, path, needle, KEYS).collect()}


def test_lists_are_looked_up_not_scanned(spark, indexed):
    path, _ = indexed
    plan = S.search(spark, path, "tablet", KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(gram,") == S.RAREST and "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert S.needle_grams("tablet") == ["abl", "ble", "let", "tab"] and S.needle_grams("ab") == ["ab"] and S.needle_grams("") == []
