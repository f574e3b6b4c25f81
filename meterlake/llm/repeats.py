"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``width`` tokens, most significant digits first; suffixes
still equal after the last digit are exactly the repeated windows. Three things keep the
passes small:

* Pass 0 gives every window to one anchor: the gram of ``gram`` tokens with the lowest hash inside
  it (winnowing), the leftmost of equals. Equal windows have equal anchors at equal places, so
  no repeat is missed, and an anchor owns a run of neighbouring windows, about half of
  ``width - gram`` of them. Anchors whose gram occurs once leave.
* Anchors whose whole run is alike are repeated as a whole; one of them goes on to stand for all.
* The later passes look at blocks of windows: a block's windows have most of their tokens in
  common, and these are its digit. Blocks alone with their digit leave. Blocks shrink from pass
  to pass, to single windows. Since all windows of an anchor contain its gram, their union is
  one span, and only the blocks at its two ends are taken further.

Groups are counted by aggregation with map-side partial sums and joined back, so a passage in a
third of all documents is no hot task; no group is ever gathered.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import keyed, row_key, written

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
PLACE_BITS = 18
CHUNK = 1 << 17  # tokens hashed at once, so that a text of any length needs bounded memory


class Unit(NamedTuple):
    """Token unit and window shape."""

    name: str                 # "bytes" or "words"
    width: int                # tokens of a window
    gram: int                 # tokens of an anchor
    blocks: tuple[int, int]   # windows of a block in the first and second pass; the first is a multiple of the second


BYTES_400 = Unit("bytes", 400, 48, (32, 8))
WORDS_50 = Unit("words", 50, 10, (8, 2))


# ---- tokens -----------------------------------------------------------------------------

_NOT_SPACE = re.compile(r"\S+")


@lru_cache(maxsize=1)
def _byte_hashes() -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)


def tokens(text: str | None, unit: Unit) -> np.ndarray:
    """The text's tokens: its UTF-8 bytes, or a 64-bit hash of each word (no white space inside)."""
    if unit.name == "bytes":
        return np.frombuffer((text or "").encode(), np.uint8)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, _NOT_SPACE.findall(text or "")), np.uint64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, MULTIPLIER)]), dtype=np.uint64)
        inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
    return up, down


def _gram_hashes(part: np.ndarray, gram: int) -> np.ndarray:
    up, down = _powers((1 << PLACE_BITS) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part * up[:len(part)], dtype=np.uint64, out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * down[:len(part) - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


def _lowest(x: np.ndarray, k: int) -> np.ndarray:
    """The lowest of every k neighbours, by doubling."""
    size = 1
    while 2 * size <= k:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (k - size)], x[k - size:]) if k > size else x


def owners(seq: np.ndarray, ends: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """(gram hash, place, first window, last window) of every anchor's run of windows.

    ``seq`` holds the tokens of texts one after another, text i up to ``ends[i]``; windows do
    not cross texts. At most 2 ** PLACE_BITS tokens.
    """
    starts = len(seq) - unit.width + 1
    if starts <= 0:
        return (np.empty(0, np.int64),) * 4
    h = _gram_hashes(_byte_hashes()[seq] if unit.name == "bytes" else seq, unit.gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = h & ~low | np.arange(len(h), dtype=np.uint64)
    owner = (_lowest(packed, unit.width - unit.gram + 1) & low).astype(np.int64)
    of = np.searchsorted(ends, np.arange(starts), "right")
    inside = np.arange(starts) + unit.width <= ends[np.minimum(of, len(ends) - 1)]
    owner[~inside] = -1
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.concatenate([edges[1:], [starts]]) - 1
    keep = owner[edges] >= 0
    edges, last = edges[keep], last[keep]
    place = owner[edges]
    # a run is cut where a text ends; its owner lies in the same text
    return h[place].view(np.int64), place, edges, last


def runs(texts: list[np.ndarray], unit: Unit):
    """(text number, gram hash, place, first window, last window) of all anchors, places within the text."""
    most = 1 << PLACE_BITS
    held: list[int] = []
    size = 0

    def flush():
        lengths = np.array([len(texts[i]) for i in held])
        ends = np.cumsum(lengths)
        g, place, first, last = owners(np.concatenate([texts[i] for i in held]), ends, unit)
        of = np.searchsorted(ends, place, "right")
        base = (ends - lengths)[of]
        return np.array(held)[of], g, place - base, first - base, last - base

    for i, seq in enumerate(texts):
        if len(seq) < unit.width:
            continue
        if len(seq) > CHUNK:
            step = CHUNK - unit.width + 1
            for lo in range(0, len(seq) - unit.width + 1, step):
                part = seq[lo:lo + CHUNK]
                g, place, first, last = owners(part, np.array([len(part)]), unit)
                yield np.full(len(g), i), g, place + lo, first + lo, last + lo
            continue
        if size + len(seq) > min(CHUNK, most):
            yield flush()
            held, size = [], 0
        held.append(i)
        size += len(seq)
    if held:
        yield flush()


# ---- passes -----------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _anchor_rows(docs: DataFrame, unit: Unit) -> DataFrame:
    """One row per anchor: row key, place, range ``lo .. hi`` of the distances from its windows' starts
    to it, gram hash ``g`` and hash ``c`` of all tokens of its windows."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                seqs = [tokens(t, unit) for t in part.column(2).to_pylist()]
                k1s, k2s = part.column(0).to_numpy(), part.column(1).to_numpy()
                for of, g, place, first, last in runs(seqs, unit):
                    raw = {i: (seqs[i].tobytes(), seqs[i].itemsize) for i in set(of.tolist())}
                    around = np.fromiter((
                        xxhash.xxh3_64_intdigest(raw[i][0][a * raw[i][1]:(b + unit.width) * raw[i][1]], seed=d)
                        for i, a, b, d in zip(of.tolist(), first.tolist(), last.tolist(), (place - first).tolist())), np.uint64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k1s[of]), pa.array(k2s[of]), pa.array(place.astype(np.int64)), pa.array((place - last).astype(np.int32)),
                        pa.array((place - first).astype(np.int32)), pa.array(g), pa.array(around.view(np.int64))],
                        ["k1", "k2", "place", "lo", "hi", "g", "c"])

    return docs.select(*row_key(), "text").mapInArrow(_merged(run), "k1 long, k2 long, place long, lo int, hi int, g long, c long")


def _merged(run, rows: int = 20_000):
    """``run`` with its small batches joined into larger ones."""
    def merged(batches):
        held, count = [], 0
        for b in run(batches):
            held.append(b)
            count += b.num_rows
            if count >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return merged


SURE, MAY = 0, 1


def _keys(table: DataFrame, unit: Unit, size: int, within: int | None) -> DataFrame:
    """Digits of one pass for the anchors in ``table.list``: ``(did, place, kind, a, h1, h2)``.

    Windows are named by the distance ``a`` from their start to the anchor. A SURE row is the
    window at the start of a block of ``size`` windows, a MAY row what the block's windows
    have in common. Only the blocks of ``within`` windows whose numbers the list gives are
    looked at; all of them if ``within`` is None. Single windows have SURE rows only.
    """
    def emit(text, anchors, did, out):
        seq = tokens(text, unit)
        data, w = seq.tobytes(), seq.itemsize
        digest, width = xxhash.xxh3_128_intdigest, unit.width
        for x in anchors:
            place, lo, hi = x["place"], x["lo"], x["hi"]
            spans = [(lo, hi)] if within is None else [(max(lo, b * within), min(hi, b * within + within - 1)) for b in x["parts"]]
            for low, high in spans:
                for a in range(low // size * size, high + 1, size):
                    if a >= low:
                        at = place - a
                        out.append((did, place, SURE, a, digest(data[at * w:(at + width) * w], seed=a)))
                    if size > 1:
                        at = place - a
                        out.append((did, place, MAY, a, digest(data[at * w:(at + width - size + 1) * w], seed=a)))

    def batch_of(out):
        did, place, kind, a, h = zip(*out)
        return pa.RecordBatch.from_arrays([
            pa.array(did, pa.int64()), pa.array(place, pa.int64()), pa.array(kind, pa.int8()), pa.array(a, pa.int32()),
            pa.array([_signed(x >> 64) for x in h], pa.int64()), pa.array([_signed(x & (1 << 64) - 1) for x in h], pa.int64())],
            ["did", "place", "kind", "a", "h1", "h2"])

    def run(batches):
        out = []
        for batch in batches:
            for row in batch.to_pylist():
                emit(row["text"], row["list"], row["did"], out)
                if len(out) > 50_000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    return table.select("did", "text", "list").mapInArrow(run, "did long, place long, kind byte, a int, h1 long, h2 long")


def _repeated(keys: DataFrame, name: str) -> DataFrame:
    """The rows whose digit another row has too."""
    keys = written(keys, name)
    # written, so that the join stands alone and a digit that very many rows share can be split
    more = written(keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), name)
    return written(keys.join(more, ["h1", "h2"], "left_semi"), name)


def _with_list(texts: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    return rows.groupBy("did").agg(F.collect_list(F.struct("place", *fields)).alias("list")).join(texts, "did")


def _ends(*sure: DataFrame) -> DataFrame:
    """(did, place) -> lowest and highest distance of a window known to be repeated."""
    known = reduce(DataFrame.unionByName, [x.filter(F.col("kind") == SURE).select("did", "place", "a") for x in sure])
    return known.groupBy("did", "place").agg(F.min("a").alias("least"), F.max("a").alias("most"))


def _asked(found: DataFrame, going: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """Anchors with the numbers of their blocks that the next pass takes up.

    A block is wanted where it may hold a repeated window outside the known ends. Everyone who
    shares the wanted block's digit is asked, since a window is repeated only if the others show theirs.
    """
    blocks = found.filter(F.col("kind") == MAY)
    wanted = blocks.join(going.filter(~F.col("whole")), ["did", "place"]).join(ends, ["did", "place"], "left").filter(
        F.col("most").isNull() | (F.least(F.col("a") + size - 1, F.col("hi")) > F.col("most")) | (F.greatest(F.col("a"), F.col("lo")) < F.col("least")))
    asked = blocks.join(wanted.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
    parts = asked.groupBy("did", "place").agg(F.collect_set((F.col("a") / size).cast("int")).alias("parts"))
    return parts.join(going.select("did", "place", "lo", "hi"), ["did", "place"])


def covered(docs: DataFrame, unit: Unit) -> tuple[DataFrame, DataFrame]:
    """(``texts (did, k1, k2, text)``, ``spans (did, first, end)`` in tokens) of the rows that may have repeats.

    A token is in a span exactly if a window that covers it starts anywhere else too, in
    another row or in the same one. Spans may overlap. Rows alike in id and text count as
    several rows but share one ``did``.
    """
    found = written(_anchor_rows(docs, unit), "anchors")
    # the counts are written before each join, so that a join stands alone and a hot gram can be split
    often = written(found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "often")
    found = written(found.join(often, "g", "left_semi"), "anchors")
    groups = written(found.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one")), "groups")
    kinds = written(groups.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")), "kinds")
    seen = found.join(written(groups.join(kinds, "g"), "groups"), ["g", "c"]) \
        .withColumn("goes_on", (F.col("kinds") > 1) & (F.struct("k1", "k2", "place") == F.col("one")))
    seen = seen.filter("n > 1 or goes_on").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("place", (F.col("n") > 1).alias("whole"), "goes_on", "lo", "hi")).alias("all"))
    texts = written(docs.select(*row_key(), "text").join(seen.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
                    .select(F.monotonically_increasing_id().alias("did"), "k1", "k2", "text", "all"), "texts")
    rows = texts.select("did", F.inline("all"))
    whole = rows.filter("whole").select("did", (F.col("place") - F.col("hi")).alias("first"), (F.col("place") - F.col("lo") + unit.width).alias("end"))
    going = written(rows.filter("goes_on").select("did", "place", "whole", "lo", "hi"), "going")
    texts = texts.drop("all")

    large, small = unit.blocks
    one = _repeated(_keys(_with_list(texts, going, "lo", "hi"), unit, large, None), "pass-1")
    asked = _asked(one, going, _ends(one), large)
    two = _repeated(_keys(_with_list(texts, asked, "lo", "hi", "parts"), unit, small, large), "pass-2")
    asked = _asked(two, going, _ends(one, two), small)
    three = _repeated(_keys(_with_list(texts, asked, "lo", "hi", "parts"), unit, 1, small), "pass-3")
    part = _ends(one, two, three).select("did", (F.col("place") - F.col("most")).alias("first"), (F.col("place") - F.col("least") + unit.width).alias("end"))
    return texts, written(whole.unionByName(part), "spans")


def _union_spans(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["first"], s["end"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _cut(docs: DataFrame, unit: Unit, change, schema: str) -> DataFrame:
    """Row keys and what ``change(text, merged spans)`` returns, for the rows with repeats."""
    texts, spans = covered(docs, unit)
    rows = spans.groupBy("did").agg(F.collect_set(F.struct("first", "end")).alias("spans")).join(texts, "did")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                yield pa.RecordBatch.from_pylist([
                    dict(zip(names, (r["k1"], r["k2"], *change(r["text"], _union_spans(r["spans"])))))
                    for r in batch.slice(lo, 64).to_pylist()])

    return rows.select("k1", "k2", "text", "spans").mapInArrow(run, schema)


def byte_report(docs: DataFrame, unit: Unit = BYTES_400) -> DataFrame:
    """Contract of ``op5_suffix_repeats``: per document the bytes, removed bytes, removed runs and a hash
    of what remains. Null and empty texts have none and remain empty; texts shorter than a
    window keep every byte. Repeated rows repeat each other. Other columns are ignored.
    """
    def change(text, spans):
        data = text.encode()
        kept, at = hashlib.sha256(), 0
        for lo, hi in spans:
            kept.update(data[at:lo])
            at = hi
        kept.update(data[at:])
        return sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest()

    found = written(_cut(docs, unit, change, "k1 long, k2 long, n_removed long, n_spans long, sha string"), "cut")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *row_key(), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(F.encode(text, "UTF-8"), 256).alias("all"))
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "all").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, unit: Unit = WORDS_50) -> DataFrame:
    """``docs`` with every repeated window of words cut from its text, all columns kept.

    A cut runs from the first word's first character to the last word's last one, with the
    white space around the rest as it was. Texts without repeats stay as they are, null texts
    too; a text that is all repeats becomes empty.
    """
    if unit.name != "words":
        raise ValueError("texts are cut between words")

    def change(text, spans):
        places = [m.span() for m in _NOT_SPACE.finditer(text)]
        out, at = [], 0
        for lo, hi in spans:
            out.append(text[at:places[lo][0]])
            at = places[hi - 1][1]
        return ("".join([*out, text[at:]]),)

    found = written(_cut(docs, unit, change, "k1 long, k2 long, cut string"), "cut")
    return keyed(docs).join(found.hint("merge"), ["k1", "k2"], "left") \
        .select(F.col("row").withField("text", F.coalesce("cut", "row.text")).alias("row")).select("row.*")
