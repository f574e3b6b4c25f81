"""Benchmark decontamination with DataFrame functions only.

Texts become lists of words; a window is N consecutive words of a benchmark item (a shorter
item is one window). Hashing every window of every document would cost a hash of N words per
word. Instead documents are cut into aligned blocks of M = (N + 1) / 2 words: any window of N
words covers a whole block. The blocks are looked up in a broadcast hash set of all M-word
runs of the windows, and only around a block that is found are windows formed, looked up, and
compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import keyed, lower_ascii, row_key, written

N = 10
#: Separators of words once A-Z are lower-cased; and of words in the text as it is.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Benchmark rows (windows, runs) up to which the sets are broadcast: at most about 100 MB.
#: Beyond it the same lookups are shuffled joins.
BROADCAST_ROWS = 1_000_000
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct ``(item_id, len, window, hash)``; items without words have none."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter("size(w) > 0") \
        .withColumn("len", F.least(F.size("w"), F.lit(n)))
    return items.select("item_id", "len", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - F.col("len")),
                                                                lambda p: F.slice(F.col("w"), p + 1, F.col("len")))).alias("window")) \
        .distinct().withColumn("hash", F.xxhash64("window"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "doc_id") -> DataFrame:
    """Occurrences ``(k1, k2, p, len, item_id)``: the window at word ``p`` of a row is one of the item's."""
    bench = written(windows(benchmark, n), "windows")
    bounded = bench.count() * n <= BROADCAST_ROWS
    hint = F.broadcast if bounded else (lambda df: df)
    lengths = [r["len"] for r in bench.select("len").distinct().orderBy("len").collect()]  # n values at most
    texts = docs.select(*row_key(id_col), words(F.col("text")).alias("w"))
    out = None
    for size in sorted({(k + 1) // 2 for k in lengths}):
        mine = [k for k in lengths if (k + 1) // 2 == size]
        runs = bench.filter(F.col("len").isin(mine)).select(F.explode(F.transform(
            F.sequence(F.lit(1), F.col("len") - size + 1), lambda o: F.xxhash64(F.slice("window", o, size)))).alias("run")).distinct()
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size("w") / size).cast("int") - 1),
                             lambda j: F.xxhash64(F.slice("w", j * size + 1, size)))
        blocks = F.when(F.size("w") >= size, blocks)
        if bounded:
            near = texts.select("k1", "k2", "w", F.posexplode(blocks).alias("j", "run")).join(hint(runs), "run", "left_semi")
        else:
            found = texts.select("k1", "k2", F.posexplode(blocks).alias("j", "run")).join(runs, "run", "left_semi")
            near = found.select("k1", "k2", "j").distinct().join(texts.dropDuplicates(["k1", "k2"]), ["k1", "k2"])
        for k in mine:
            first = F.greatest(F.lit(0), F.col("j") * size - (k - size))
            last = F.least(F.col("j") * size, F.size("w") - k)
            around = near.select("k1", "k2", F.explode(F.when(first <= last, F.transform(
                F.sequence(first, F.greatest(first, last)), lambda p: F.struct(p.alias("p"), F.slice("w", p + 1, F.lit(k)).alias("window"))))).alias("c")) \
                .select("k1", "k2", "c.p", F.col("c.window").alias("text_window"), F.xxhash64("c.window").alias("hash"))
            same = hint(bench.filter(F.col("len") == k).select("item_id", "hash", "window"))
            part = around.join(same, "hash").filter("text_window = window").select("k1", "k2", "p", F.lit(k).alias("len"), "item_id")
            out = part if out is None else out.unionByName(part)
    if out is None:  # a benchmark without words
        return texts.limit(0).select("k1", "k2", F.lit(0).alias("p"), F.lit(0).alias("len"), F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"))
    return out


def _by_row(found: DataFrame) -> DataFrame:
    places = F.transform(F.collect_set(F.struct("p", "len")), lambda x: F.sequence(x["p"], x["p"] + x["len"] - 1))
    return found.groupBy("k1", "k2").agg(F.array_distinct(F.flatten(places)).alias("hit"),
                                         F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Contract of ``op6_benchmark_ngrams``: one row per document with its words, hit words and items.

    Null and empty texts have no words. Documents alike in id and text are alike here, one row
    each. An empty benchmark contaminates nothing. Other columns are ignored.
    """
    found = _by_row(hits(docs, benchmark, n))
    rows = docs.select("doc_id", *row_key(), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.when(F.col("items").isNull(), EMPTY_SHA).otherwise(F.sha2(F.array_join("items", ","), 256)).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N, whole_documents: bool = False) -> DataFrame:
    """``docs`` without contaminated spans: hit words go, each with the separator after it.

    With ``whole_documents`` the contaminated documents go instead. Documents that are clean
    keep their text unchanged, null texts included; a document that was all benchmark keeps
    an empty text. All columns stay; the order of columns too.
    """
    found = _by_row(hits(docs, benchmark, n)).select("k1", "k2", "hit")
    if whole_documents:
        return keyed(docs).join(found.hint("merge"), ["k1", "k2"], "left_anti").select("row.*")
    text = F.col("row.text")
    between = F.split(text, WORD)
    # zipped first: what a lambda names from outside is worked out anew for every word
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(f"({WORD})")).alias("w"), F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0))).alias("s"))
    kept = F.transform(pairs, lambda x, i: F.when(F.array_contains("hit", i), "").otherwise(F.concat(x["w"], x["s"])))
    cut = F.concat(F.element_at(between, 1), F.array_join(kept, ""))
    return keyed(docs).join(found.hint("merge"), ["k1", "k2"], "left") \
        .select(F.col("row").withField("text", F.when(F.col("hit").isNull(), text).otherwise(cut)).alias("row")).select("row.*")
