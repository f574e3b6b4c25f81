import hashlib
import zlib

import pytest

from meterlake.llm import merkle
from meterlake.llm.catalog import QUERIES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fields(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(nodes):
    """Levels of the tree over ``nodes``, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([H(*low[i:i + 3]) for i in range(0, len(low), 3)])
    return levels


def way(levels, at):
    for level in levels[:-1]:
        lo = at // 3 * 3
        yield level[lo:at], level[at + 1:lo + 3]
        at //= 3


def brute(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    first = lambda x: (x is not None, (x or "").encode() if isinstance(x, str) or x is None else x)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r, fields(*r)))
    sources = sorted(by_source, key=first)
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = grow([leaf for _, leaf in by_source[s]])
    top = grow([trees[s][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for j, (r, leaf) in enumerate(by_source[s]):
            path = [*way(trees[s], j), *way(top, i)]
            changed = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                changed = fields(*r[:4], r[4].replace("\n", ""))
            for left, right in path:
                changed = H(*left, changed, *right)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], H(*[x for left, right in path for x in left + right]), changed, changed == top[-1][0]))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [4, 1, 10, 28], [81, 82], [730, 3, 2200]])
def test_manifest_equals_a_tree_built_by_hand(spark, sizes):
    """Full and short runs, lone leaves, and sources of one, two and several blocks."""
    rows = [(100 * i + 7, f"s{k}", "en", i, f"text {i}\nof {k}") for k, n in enumerate(sizes) for i in range(n)]
    assert rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows), key=str)


def test_three_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, f"s{i % 200}" if i % 3 else None, "en", i, f"text {i}\n") for i in range(900)]
    assert rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows), key=str)


def test_odd_documents(spark, odd_docs, odd_rows):
    """Nulls in any column, repeated rows, a repeated and a null id, clashing extra columns."""
    rows = [(i, s, lang, n, t) for i, t, lang, s, n in odd_rows] + [
        (3, None, None, None, None), (None, None, "en", 1, "a\nb"), (None, None, "en", 1, "a\nb"), (4, "", "de", 0, ""), (4, "é", "de", 2, "\n\n"), (4, "z", "x", 1, "-")]
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars int, idx int, h string")
    assert rows_of(merkle.manifest(docs)) == sorted(brute(rows), key=str)


def test_no_documents(spark, no_docs):
    assert merkle.manifest(no_docs).collect() == []


def test_query_on_given_documents(spark):
    d = "/root/testdata/sf0.001"
    got = rows_of(QUERIES["op12_merkle"](spark, d))
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert got == sorted(brute(rows), key=str)
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")}
    assert {r[0] for r in got if not r[6]} == changed and changed


def test_one_source_holds_most_rows(spark):
    """A block is the most that one task holds, however large the source."""
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.lit("s").alias("grp"), F.lit(5000).cast("long").alias("n"), F.col("id").alias("idx"), F.lit("0").alias("h"), F.lit(1).alias("load"))
    kids = merkle.nest(rows).collect()
    assert len(kids) == -(-5000 // merkle.BLOCK)
