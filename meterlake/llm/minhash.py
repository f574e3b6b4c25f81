"""Near duplicates by Order MinHash, verified by banded alignment.

A text is a list of lower-cased words, its k-mers are runs of five words, and a k-mer that
occurs again is told apart by the number of its occurrence. A sketch draws the L k-mers of
lowest hash and keeps them in text order, so two texts share a sketch only if they share those
k-mers in one order: sharing follows edit similarity, not just the set of words. Two texts
whose k-mer sets have Jaccard J share one of the SKETCHES sketches with probability about
1 - (1 - J ** L) ** SKETCHES: 0.96 at J = 0.2 (every fifth word changed), more than 0.9999 at 0.35
and above. Texts of up to SHORT words share a prefix besides: the lowest hashes of their labelled
pairs of words, as many as the edits allowed can break and one more. No pair of them is missed.

Candidates are verified by the edit distance of their words inside a band: they are linked at a
similarity 1 - distance / words of the longer text of 0.8 or more. Classes are the connected
components of the links.

A bucket (texts with one sketch) never emits all its pairs. First every text is aligned with
the lowest one of its buckets' lowest ones, then those outside a bucket's largest class with members of it that each
bucket draws; this settles families of copies. Then the texts outside the
bucket's largest class are held against every text of the bucket in another class, block by block inside a task: pairs
that exact bounds (length, counts of the words) rule out make no row, the others are aligned; a pair that shares several
buckets is taken in the first of them. A text travels once a block and not once a pair, and once only in a bucket of one
block, its counts of words packed. Every candidate pair is thus aligned, ruled out exactly, or in one class already.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import components, keyed, row_key, written

K, L, SKETCHES = 5, 2, 80
#: Words up to which texts are candidates by the prefix of their pairs of words.
SHORT = 50
SIMILARITY = 0.8
BIT_WORDS, PLANES = 64, 2  # longs of a plane of word counts: 4096 counts up to PLANES show most differing words of texts up to 1000 words
#: Rounds in which texts outside a bucket's largest class meet DRAWN members of it.
STAR_ROUNDS, DRAWN = 1, 2
#: Texts in a block of the texts outside a bucket's largest class, and of all texts of a bucket; their counts of words travel, not the words.
TEXTS_MINOR, TEXTS_ALL = 2_000, 8_000
#: Words of the pairs that one group aligns, each text counted once a pair.
PAIR_WORDS = 500_000
#: Rows of buckets that one group compares by their word counts, on average.
ROWS_DEALT = 3_000
_WORD = re.compile(r"\w+")
#: Blanks for the ASCII characters that are in no word.
_ASCII_WORDS = {i: " " for i in range(128) if not _WORD.match(chr(i))}
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _MIX
        return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash, for one task; emptied when it grows past ``limit``."""

    limit = 400_000

    def __missing__(self, word):
        if len(self) > self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None, hashes: dict) -> np.ndarray:
    text = (text or "").lower()
    found = text.translate(_ASCII_WORDS).split() if text.isascii() else _WORD.findall(text)
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def _labelled(h: np.ndarray) -> np.ndarray:
    """Hashes that tell the occurrences of an equal hash apart; a first occurrence keeps its own."""
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    if new.all():
        return h
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    label = np.empty(len(h), np.uint64)
    label[order] = (np.arange(len(h)) - first).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(label > 0, _mixed(h + label * np.uint64(0xC2B2AE3D27D4EB4F)), h)


def kmers(seq: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers; one for a text of fewer than K words."""
    k = min(K, len(seq))
    with np.errstate(over="ignore"):
        h = np.zeros(len(seq) - k + 1, np.uint64)
        for i in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + seq[i:len(seq) - k + 1 + i]
    return _labelled(_mixed(h))


_SEEDS = _mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64))


def sketch(h: np.ndarray) -> np.ndarray:
    """SKETCHES hashes, each of the L lowest k-mers of one permutation in text order."""
    n, low = len(h), min(L, len(h))
    rows = max(1, min(SKETCHES, 2_000_000 // n))  # bounds the memory for very long texts
    out = np.empty(SKETCHES, np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, SKETCHES, rows):
            seeds = _SEEDS[lo:lo + rows, None]
            v = (h[None, :] ^ seeds) * _MIX
            v ^= v >> np.uint64(32)
            v *= _MIX
            at = np.empty((len(seeds), low), np.intp)
            for i in range(low):
                at[:, i] = v.argmin(axis=1)
                v[np.arange(len(seeds)), at[:, i]] = ~np.uint64(0)
            picked = h[np.sort(at, axis=1)]
            key = seeds[:, 0].copy()
            for i in range(low):
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + picked[:, i])
            out[lo:lo + rows] = key
    return out


def prefix(seq: np.ndarray) -> np.ndarray:
    """The lowest hashes of a short text's labelled pairs of words; two texts of similarity SIMILARITY share one.

    An edit breaks two pairs at most on either side, so t edits leave each side at most 2 * t pairs
    that the other lacks, and the 2 * t + 1 lowest of both meet. The longer text of a pair allows
    n / 4 edits of the shorter one's n words at most.
    """
    if not 4 <= len(seq) <= SHORT:
        return np.empty(0, np.uint64)  # 3 words allow no edit, nor do they against 4
    with np.errstate(over="ignore"):
        pairs = _labelled(_mixed(seq[:-1] * np.uint64(0x9E3779B97F4A7C15) + seq[1:]))
        most = int(len(seq) * (1 - SIMILARITY) / SIMILARITY + 1e-9)
        return _mixed(np.sort(pairs)[:2 * most + 1] + np.uint64(0xC2B2AE3D27D4EB4F))


def bitmap(seq: np.ndarray) -> np.ndarray:
    """Counts of a text's words, a word that occurs again as another one: bit i of plane p is 1
    where more than p words fall on i. So the bits that one text has and another lacks are no
    more than the words that the other lacks."""
    n = 64 * BIT_WORDS
    count = np.bincount(((_labelled(seq) if len(seq) else seq) >> np.uint64(7)).astype(np.int64) % n, minlength=n)
    return np.packbits(count > np.arange(PLANES)[:, None]).view(np.int64)


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of two word sequences if it is at most ``most``, else None.

    Bit-parallel dynamic programming (Myers 1999, banded as in Hyyro 2003): the cells of a
    column inside the band of 2 * most + 1 diagonals are the bits of one integer.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    same = a[:len(b)] == b
    start = len(b) if same.all() else int(np.argmin(same))
    a, b = a[start:], b[start:]
    if len(b):
        same = a[::-1][:len(b)] == b[::-1]
        end = len(b) if same.all() else int(np.argmin(same))
        a, b = a[:len(a) - end], b[:len(b) - end]
    n, m = len(a), len(b)
    if not m:
        return n if n <= most else None
    t = min(most, n)
    if not t:
        return None
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    width = 2 * t + 1
    full = (1 << width) - 1
    diagonal, last = 1 << width - 1, 1 << width - 2
    vp, vn = ((1 << t + 1) - 1) << (width - t - 1), 0
    distance, start = t, t + 1 - width
    worst = t + m - (n - t)
    sequence = iter(b.tolist())
    for w in islice(sequence, max(0, n - t)):
        x = at.get(w, 0)
        x = (x >> start if start >= 0 else x << -start) & full
        d0 = (((x & vp) + vp) ^ vp | x | vn) & full
        hp, hn = vn | full & ~(d0 | vp), d0 & vp
        if not d0 & diagonal:
            distance += 1
            if distance > worst:
                return None
        d0 >>= 1
        vp, vn = hn | full & ~(d0 | hp), d0 & hp
        start += 1
    for w in sequence:
        x = at.get(w, 0)
        x = (x >> start if start >= 0 else x << -start) & full
        d0 = (((x & vp) + vp) ^ vp | x | vn) & full
        hp, hn = vn | full & ~(d0 | vp), d0 & vp
        distance += bool(hp & last) - bool(hn & last)
        last >>= 1
        d0 >>= 1
        vp, vn = hn | full & ~(d0 | hp), d0 & hp
        start += 1
    return distance if distance <= most else None


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether 1 - distance / longer length is at least ``least``; narrow bands are tried first."""
    longest = max(len(a), len(b))
    most = int((1 - least) * longest + 1e-9)
    if min(len(a), len(b)) < longest - most:
        return False
    if longest - min(int(np.isin(a, b).sum()), int(np.isin(b, a).sum())) > most:
        return False  # too few words in common, whatever their order
    for t in (most // 8, most):
        if banded_distance(a, b, t) is not None:
            return True
    return False


def close(an: np.ndarray, ac: np.ndarray, abits: np.ndarray, bn: np.ndarray, bc: np.ndarray, bbits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the texts of two blocks in different classes that lengths and counts of words allow to be similar.

    ``n``: numbers of words, ``c``: classes, ``bits``: bitmaps, PLANES * BIT_WORDS longs each.
    """
    order = np.argsort(bn, kind="stable")
    bn, bc, bbits = bn[order], bc[order], bbits[order].view(np.uint64)
    abits, found = abits.view(np.uint64), []
    longest = np.arange(max(an.max(initial=0), bn.max(initial=0)) + 1)
    most_of = (longest * (1 - SIMILARITY) + 1e-9).astype(np.int64)
    shortest_of = longest - most_of  # of the texts that fit a longest one; never falls
    lows, highs = np.searchsorted(bn, shortest_of[an]), np.searchsorted(shortest_of[bn], an, "right")
    for i in range(len(an)):
        j = np.arange(lows[i], highs[i])
        j = j[bc[j] != ac[i]]
        most = most_of[np.maximum(an[i], bn[j])]
        at = 0
        # words of one text that the other lacks cost an edit each; a part of the bitmap that shows too many ends it
        lost = np.zeros((2, len(j)), np.int64)
        for upto in (BIT_WORDS // 4, BIT_WORDS, PLANES * BIT_WORDS):
            x, y = abits[i, at:upto], bbits[j, at:upto]
            lost += np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
            fits = (lost <= most).all(axis=0)
            j, most, lost, at = j[fits], most[fits], lost[:, fits], upto
            if not len(j):
                break
        if len(j):
            found.append((np.full(len(j), i), order[j]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


# ---- Spark ------------------------------------------------------------------------------

def sketches(docs: DataFrame) -> DataFrame:
    """Per row: row key, hash of its words (h1, h2), number of words, sketches. Rows without words have null sketches."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                h1, h2, n, keys = [], [], [], []
                for text in part.column(3).to_pylist():
                    seq = words(text, hashes)
                    d = xxhash.xxh3_128_intdigest(seq.tobytes())
                    h1.append(d >> 64)
                    h2.append(d & (1 << 64) - 1)
                    n.append(len(seq))
                    keys.append(np.concatenate([sketch(kmers(seq)), prefix(seq)]).view(np.int64) if len(seq) else None)
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], signed(h1), signed(h2), pa.array(np.array(n, np.int32)),
                    pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "k1", "k2", "h1", "h2", "n", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *row_key(), "text").mapInArrow(
        run, f"doc_id {kind}, k1 long, k2 long, h1 long, h2 long, n int, keys array<long>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs (a, b)`` of nodes whose words align; ``texts (node, seq)`` has their word hashes."""
    def run(batches):
        for batch in batches:
            a, b, x, y = batch.columns
            keep = [similar(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)) for i in range(batch.num_rows)]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("seq").alias("x")), "a") \
        .join(texts.select(F.col("node").alias("b"), F.col("seq").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _verified_in_blocks(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs (key, ab, bb, part, a, b)`` of nodes whose words align. A part of a block holds its texts once."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        seqs = {node: np.frombuffer(seq, np.uint64) for node, seq in zip(right["node"].to_pylist(), right["seq"].to_pylist())}
        counted = {node: np.sort(_labelled(seq)) for node, seq in seqs.items()}
        keep = []
        for a, b in zip(left["a"].to_pylist(), left["b"].to_pylist()):
            x, y = counted[a], counted[b]
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            longest = max(len(x), len(y))
            keep.append(longest - common <= int((1 - SIMILARITY) * longest + 1e-9) and similar(seqs[a], seqs[b]))
        return left.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    block = ["key", "ab", "bb", "part"]
    needed = pairs.select(*block, F.col("a").alias("node")).union(pairs.select(*block, F.col("b").alias("node"))).distinct()
    held = needed.join(texts.select("node", "seq"), "node").select(*[F.col(c).alias(f"in_{c}") for c in block], "node", "seq")
    return pairs.groupBy(*block).cogroup(held.groupBy(*[f"in_{c}" for c in block])).applyInArrow(run, "a long, b long")


def _close_in_blocks(members: DataFrame, groups: int) -> DataFrame:
    """Pairs ``(key, ab, bb, part, a, b)`` of a bucket's texts in different classes, a outside the largest class, that exact bounds allow.

    ``members``: key, node, n, comp, minor, keys, bits (packed) and the bucket's numbers of blocks ``few`` and ``all``. A block of the texts
    outside the largest class meets every block of the bucket's texts; a bucket that is one block travels once. Small blocks share a group,
    at least ``groups`` in all. The pairs of a block are cut into parts of about PAIR_WORDS words, texts ``a`` in one part each.
    """
    kept = ["key", "ab", "bb", "whole", "node", "n", "comp", "minor", "keys", "bits"]
    made = ["key", "ab", "bb", "part", "a", "b"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = (t.rename_columns(["dealt", *kept]) for t in (left, right))

        def column(t, name):
            return t[name].combine_chunks().to_numpy(zero_copy_only=False)

        def sides(t):
            block = np.stack([column(t, c) for c in ("key", "ab", "bb")])
            order = np.lexsort(block)
            block = block[:, order]
            first = np.flatnonzero(np.concatenate([[True], (block[:, 1:] != block[:, :-1]).any(axis=0)])) if len(order) else order
            ends = np.append(first[1:], len(order))
            at = {tuple(block[:, lo].tolist()): order[lo:hi] for lo, hi in zip(first.tolist(), ends.tolist())}
            return at, [column(t, c) for c in ("node", "n", "comp", "minor")], t["bits"].combine_chunks(), t["keys"].combine_chunks()

        def unpacked(bits, rows):
            return np.frombuffer(b"".join(zlib.decompress(bits[i].as_buffer()) for i in rows.tolist()), np.int64).reshape(-1, PLANES * BIT_WORDS)

        one, two = sides(left), sides(right)
        whole, out = column(right, "whole"), {c: [] for c in made}
        for block, others in two[0].items():
            _, (b, bn, bc, minor), bbits, bkeys = two
            bits = unpacked(bbits, others)
            if whole[others[0]]:
                few = np.flatnonzero(minor[others])
                (a, an, ac, _), akeys, rows, few_bits = two[1], bkeys, others[few], bits[few]
            elif block in one[0]:
                (a, an, ac, _), akeys, rows = one[1], one[3], one[0][block]
                few_bits = unpacked(one[2], rows)
            else:
                continue
            i, j = close(an[rows], ac[rows], few_bits, bn[others], bc[others], bits)
            i, j = rows[i], others[j]
            once = ~minor[j] | (a[i] < b[j])
            i, j = i[once], j[once]
            # a pair that meets in several buckets is taken in the first of them: no other key that both have is lower
            lower = [{x: {k for k in keys[x].as_py() if k < block[0]} for x in np.unique(of).tolist()} for of, keys in ((i, akeys), (j, bkeys))]
            here = np.fromiter((lower[0][x].isdisjoint(lower[1][y]) for x, y in zip(i.tolist(), j.tolist())), bool, len(i))
            i, j = i[here], j[here]
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            before = np.cumsum(an[i].astype(np.int64) + bn[j]) - an[i] - bn[j]
            part = before[np.searchsorted(i, i)] // PAIR_WORDS
            for c, v in zip(made, (*[np.full(len(i), x, np.int64) for x in block], part, a[i], b[j])):
                out[c].append(v)
        return pa.table({c: pa.array(np.concatenate([np.empty(0, np.int64), *v]), pa.int64()) for c, v in out.items()})

    spread = lambda other: F.explode(F.sequence(F.lit(0), F.col(other).cast("long") - 1))
    members = members.withColumn("whole", F.expr("few = 1 and all = 1"))
    one = members.filter("minor and not whole").withColumn("ab", F.pmod(F.xxhash64("node"), "few")).withColumn("bb", spread("all"))
    two = members.filter("few > 0").withColumn("bb", F.pmod(F.xxhash64("node"), "all")).withColumn("ab", spread("few"))
    dealt = F.pmod(F.xxhash64("key", "ab", "bb"), F.lit(max(1, groups))).alias("dealt")
    # named anew, since a cogroup takes no two sides with the same columns
    one, two = (df.select(dealt, *[(F.col(c).cast("long") if c in ("ab", "bb") else F.col(c)).alias(f"{x}_{c}") for c in kept]) for x, df in (("a", one), ("b", two)))
    two = two.withColumnRenamed("dealt", "b_dealt")
    return one.groupBy("dealt").cogroup(two.groupBy("b_dealt")).applyInArrow(run, ", ".join(f"{c} long" for c in made))


def _words_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, seq, bits)``: the word hashes of the texts that stand for ``nodes (node, k1, k2)``, and their packed bitmap."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                seqs = [words(t, hashes) for t in part.column(1).to_pylist()]
                bits = [zlib.compress(bitmap(seq).tobytes(), 1) for seq in seqs]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([seq.tobytes() for seq in seqs], pa.binary()), pa.array(bits, pa.binary())],
                                                 ["node", "seq", "bits"])

    texts = docs.select(*row_key(), "text").join(nodes, ["k1", "k2"]).dropDuplicates(["node"])
    return texts.select("node", "text").mapInArrow(run, "node long, seq binary, bits binary")


def _most(longest: Column) -> Column:
    """Edits that two texts may be apart."""
    return F.floor(longest * (1 - SIMILARITY) + 1e-9)


def _fitting(an: Column, bn: Column) -> Column:
    """Whether the lengths of two texts allow the similarity."""
    longest = F.greatest(an, bn)
    return F.least(an, bn) >= longest - _most(longest)


def _placed(df: DataFrame, comps: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the component of ``col``; a node without links is its own."""
    return df.join(comps.select(F.col("id").alias(col), F.col("comp").alias(out)), col, "left").withColumn(out, F.coalesce(out, col))


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components ``(id, comp)`` after the new ``links (a, b)``: the links join whole components."""
    if comps is None:
        return written(components(links), "components")
    if not links.limit(1).count():
        return comps
    between = _placed(_placed(links, comps, "a", "x"), comps, "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = written(components(between), "components")
    every = comps.union(joined.select("id", F.col("id").alias("comp"))).distinct()
    return written(_placed(every.withColumnRenamed("comp", "part"), joined, "part", "comp").select("id", "comp"), "components")


def _by_class(buckets: DataFrame, comps: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Bucket members with their component, and for every bucket of several components its
    largest one (``main``) with DRAWN of its members, picked by a hash of bucket and turn."""
    placed = written(_placed(buckets.select("key", "node", "n"), comps, "node", "comp"), "placed")
    drawn = [F.min_by(F.struct(F.col("node").alias("m"), F.col("n").alias("mn")), F.xxhash64("node", "key", F.lit(turn * DRAWN + i))).alias(f"d{i}") for i in range(DRAWN)]
    parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"), *drawn)
    best = F.max_by(F.struct("comp", *[f"d{i}" for i in range(DRAWN)]), F.struct("size", "comp")).alias("b")
    largest = parts.groupBy("key").agg(best, F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    return placed, written(largest.select("key", F.col("b.comp").alias("main"), F.array(*[f"b.d{i}" for i in range(DRAWN)]).alias("drawn")), "largest")


def classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, k1, k2, class_id)`` for every row; ``class_id`` is the lowest doc_id of the row's class.

    Texts with the same words are one node of the graph, whatever their case and punctuation.
    Rows without words (null, empty, no letters or digits) are classes of their own, except
    that rows alike in id and text always share one.
    """
    rows = written(sketches(docs), "sketches")
    nodes = rows.filter("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("k1", "k2")).alias("one"), F.min("doc_id").alias("low"), F.first("n").alias("n"),
        F.first("keys").alias("keys"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "one.k1", "one.k2", "low", "n", "keys"), "nodes")

    drawn = nodes.select("node", "n", F.explode(F.array_distinct("keys")).alias("key"))
    # written, so that the join below stands alone and a bucket of very many texts can be split
    heads = drawn.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    heads = written(heads.select("key", F.col("head.node").alias("head"), F.col("head.n").alias("headn")), "heads")
    buckets = written(drawn.join(heads, "key"), "buckets")
    texts = written(_words_of(docs, nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "k1", "k2")), "words")
    # every text meets the lowest of its heads first: one pair a text, which settles most families
    stars = buckets.filter((F.col("node") != F.col("head")) & _fitting(F.col("headn"), F.col("n"))).groupBy(F.col("node").alias("b")).agg(F.min("head").alias("a"))
    stars = written(stars.select("a", "b"), "pairs")
    tried, comps = stars, _merged(None, written(_verified(stars, texts), "links"))
    for turn in range(STAR_ROUNDS):
        placed, largest = _by_class(buckets, comps, turn)
        # only buckets of several classes have pairs left
        buckets = placed.join(largest, "key")
        # texts outside a bucket's largest class meet members of it that each bucket draws by itself
        apart = buckets.filter("comp <> main").select(F.explode("drawn").alias("m"), "node", "n").filter(_fitting(F.col("m.mn"), F.col("n")))
        apart = apart.select(F.least("m.m", "node").alias("a"), F.greatest("m.m", "node").alias("b")).distinct()
        stars = written(apart.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried, comps = tried.unionByName(stars), _merged(comps, written(_verified(stars, texts), "links"))

    placed, largest = _by_class(buckets, comps, STAR_ROUNDS)
    mixed = placed.join(largest.select("key", "main"), "key")
    mixed = written(mixed.select("key", "node", "n", "comp", (F.col("comp") != F.col("main")).alias("minor")), "mixed")
    held = mixed.groupBy("node").agg(F.collect_list("key").alias("keys")).join(texts.select("node", "bits"), "node")
    blocks = mixed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TEXTS_ALL).alias("all"), F.ceil(F.count_if("minor") / TEXTS_MINOR).alias("few"))
    members = mixed.join(blocks, "key").join(held, "node")  # the narrow join first, so that bitmaps are dealt out once
    rest = _close_in_blocks(members, -(-mixed.count() // ROWS_DEALT))
    rest = rest.select("*", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    rest = written(rest.join(tried.select(F.col("a").alias("lo"), F.col("b").alias("hi")), ["lo", "hi"], "left_anti").drop("lo", "hi"), "rest")
    comps = _merged(comps, written(_verified_in_blocks(rest, texts), "links"))
    classed = _placed(nodes.select("node", "h1", "h2", "low"), comps, "node", "comp")
    lowest = classed.groupBy("comp").agg(F.min("low").alias("class_id"))
    classed = classed.join(lowest, "comp").select("h1", "h2", "class_id")
    return rows.select("doc_id", "k1", "k2", "h1", "h2", "n").join(classed, ["h1", "h2"], "left") \
        .select("doc_id", "k1", "k2", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Query ``op1_order_minhash``: ``doc_id, class_id`` for every document; see ``classes``."""
    return classes(docs).select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, the one of lowest ``doc_id`` (of equal ids the lowest row key), all
    columns kept; rows alike in id and text count as one. Rows without an id stay as one
    class's choice only if no row of the class has an id.
    """
    of = classes(docs).groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("k1")).alias("alone")) \
        .agg(F.min_by(F.struct("k1", "k2"), F.struct(F.coalesce(F.col("doc_id") != F.col("class_id"), F.lit(True)), "k1", "k2")).alias("one"))
    chosen = of.select("one.k1", "one.k2")
    return keyed(docs).join(chosen.hint("merge"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
