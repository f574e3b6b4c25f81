"""Language ID by prediction by partial matching (PPM).

Per language, a tree of byte contexts of 0 to ORDER bytes holds how often each byte followed. A
byte is coded in the longest context that the tree has; a byte never seen there costs an escape
and is tried in the next shorter context, where the bytes of the longer one are excluded, as
they were ruled out already; after the empty context the remaining byte values are alike.
Escapes are estimated by method C: ``distinct / (total + distinct)``. The statistics stay frozen while
texts are scored, so these are exact code lengths: in every context the 256 probabilities sum to 1. A
text's language is the one whose tree codes it in the fewest bits.

Under frozen statistics a byte's cost depends on the ORDER bytes before it only, so a text's code
length is a sum over its windows of ORDER + 1 bytes (grams), and the trees follow from counts of grams,
which are sharded by gram and grow with the corpus. Nothing of them is gathered or broadcast but
the two lowest orders, 65,536 counts a language at most:

* texts are dealt into chunks of bounded size, and each asks for its distinct grams once;
* the distinct grams of the corpus meet the trees' counts, grouped by the two last context bytes:
  a group has every context of two bytes and more that its grams can fall back on;
* the costs go back to the chunks that asked, and each chunk adds up its texts.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import written

ORDER = 4
UNKNOWN = "und"
#: UTF-8 bytes of text that a chunk has on average; a chunk's distinct grams are asked for together.
CHUNK_BYTES = 32_000_000
#: Grams that a task counts before it hands on partial counts.
HELD = 2_000_000
#: Bytes of one text that are turned into grams at a time.
SLICE = 4_000_000
_LETTERS = re.compile(r"[^\W\d_]+")
_WIDTH = ORDER + 1


def normal(text: str | None) -> bytes:
    """The lower-cased words of letters, a space before, between and after; empty without any."""
    words = _LETTERS.findall(text.lower()) if text else []
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass") if words else b""


def grams(data: bytes):
    """Every byte of ``data`` with the ORDER bytes before it (spaces before the start), as numbers, SLICE at a time."""
    a = np.frombuffer(b" " * ORDER + data, np.uint8)
    for lo in range(0, len(data), SLICE):
        part = a[lo:lo + SLICE + ORDER].astype(np.int64)
        n = len(part) - ORDER
        g = np.zeros(n, np.int64)
        for i in range(_WIDTH):
            g = g << 8 | part[i:n + i]
        yield g


def _suffix(g: np.ndarray, length: int) -> np.ndarray:
    return g & ((1 << 8 * length) - 1)


def _grouped(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct ``keys``, sorted, and the sums of the weights of each."""
    found, at = np.unique(keys, return_inverse=True)
    return found, *[np.bincount(at, w, len(found)) for w in weights]


def _at(found: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """``values`` at the ``keys``; 0 for keys that are not ``found``."""
    if not len(found):
        return tuple(np.zeros(len(keys)) for _ in values)
    i = np.minimum(np.searchsorted(found, keys), len(found) - 1)
    hit = found[i] == keys
    return tuple(np.where(hit, v[i], 0) for v in values)


def code_lengths(asked: np.ndarray, seen: np.ndarray, counts: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Bits that the last byte of each gram ``asked`` costs after the bytes before it.

    ``seen, counts``: the grams of one language that share their two last context bytes with the
    ones asked for, or all of them; ``low[b, s]``: how often s followed b at all.
    """
    bits, open_ = np.zeros(len(asked)), np.ones(len(asked), bool)
    ruled_n, ruled_q = np.zeros(len(asked)), np.zeros(len(asked))
    root = low.sum(axis=0)

    def below(keys: np.ndarray, length: int) -> np.ndarray:
        """Counts of grams of ``length`` bytes, each a suffix of a gram that was seen or asked for."""
        if length == 1:
            return root[keys]
        if length == 2:
            return low[keys >> 8, keys & 255]
        known, c = _grouped(_suffix(seen, length), counts)
        return _at(known, keys, c)[0]

    for length in range(_WIDTH, 0, -1):
        mine = _suffix(asked, length)
        if length > 2:
            known, c = _grouped(_suffix(seen, length), counts)
            contexts, total, distinct, shorter = _grouped(known >> 8, c, np.ones(len(c)), below(_suffix(known, length - 1), length - 1))
            total, distinct, shorter = _at(contexts, mine >> 8, total, distinct, shorter)
            c = _at(known, mine, c)[0]
        elif length == 2:
            b = mine >> 8
            total, distinct, shorter = (low.sum(axis=1)[b], (low > 0).sum(axis=1)[b], ((low > 0) * root).sum(axis=1)[b])
            c = low[b, mine & 255]
        else:
            total, distinct, shorter, c = np.full(len(mine), root.sum()), np.full(len(mine), (root > 0).sum()), np.zeros(len(mine)), root[mine]
        here = open_ & (total > 0)
        left = distinct - ruled_q
        room = total - ruled_n + left
        hit, escape = here & (c > 0), here & (c == 0) & (left > 0)
        bits[hit] += np.log2(room[hit] / c[hit])
        bits[escape] += np.log2(room[escape] / left[escape])
        open_ &= ~hit
        ruled_n, ruled_q = np.where(here, shorter, ruled_n), np.where(here, distinct, ruled_q)
    bits[open_] += np.log2(256 - (root > 0).sum()) if open_.any() else 0
    return bits


# ---- Spark ------------------------------------------------------------------------------

def gram_counts(texts: DataFrame) -> DataFrame:
    """``(lang, g, c)``: how often each gram occurs in the ``texts (lang, text)`` of a language."""
    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                g, c = _grouped(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c.astype(np.int64))], ["lang", "g", "c"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for g in grams(normal(text)):
                    held.setdefault(lang, []).append((g, np.ones(len(g))))
                    size += len(g)
                if size > HELD:  # counted together first; handed on only if that did not help
                    for k, parts in held.items():
                        held[k] = [_grouped(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > HELD // 2:
                        yield from flush()
                        size = 0
        yield from flush()

    return texts.select("lang", "text").mapInArrow(run, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def _chunks(docs: DataFrame, chunks: int) -> DataFrame:
    """Documents with their compressed normal text, dealt evenly into chunks, whatever they hold."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [normal(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([zlib.compress(t, 1) if t else None for t in texts], pa.binary())],
                                                 ["chunk", "doc_id", "data"])

    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
    return docs.select(place.alias("chunk"), "doc_id", "text").mapInArrow(run, f"chunk int, doc_id {kind}, data binary").repartition(chunks, "chunk")


def _asked(chunked: DataFrame) -> DataFrame:
    """``(chunk, g)``: the distinct grams of each chunk."""
    def run(batches):
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                for g in grams(zlib.decompress(data) if data else b""):
                    held.setdefault(chunk, []).append(g)
                    size[chunk] = size.get(chunk, 0) + len(g)
                if size.get(chunk, 0) > HELD:
                    held[chunk] = [np.unique(np.concatenate(held[chunk]))]
                    size[chunk] = 0
        for chunk, parts in held.items():
            g = np.unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), chunk, np.int32)), pa.array(g)], ["chunk", "g"])

    return chunked.mapInArrow(run, "chunk int, g long")


def _costs(wanted: DataFrame, trees: DataFrame, langs: list[str], low: np.ndarray) -> DataFrame:
    """``(g, bits)``: the cost of each gram of ``wanted (g)`` in each of ``langs``."""
    def run(key, left, right):
        g, lang = left.column("g").to_numpy(), left.column("lang").to_numpy(zero_copy_only=False)
        c, asked = left.column("c").to_numpy(), right.column("g").to_numpy()
        bits = np.stack([code_lengths(asked, g[lang == k], c[lang == k], low[i]) for i, k in enumerate(langs)], axis=1)
        offsets = np.arange(0, bits.size + 1, len(langs), dtype=np.int32)
        return pa.table([pa.array(asked), pa.ListArray.from_arrays(offsets, pa.array(bits.astype(np.float32).ravel()))], ["g", "bits"])

    last_two = F.shiftright("g", 8).bitwiseAND(F.lit(65535)).alias("key")
    return trees.select(last_two, "lang", "g", "c").groupBy("key").cogroup(wanted.select(last_two, "g").groupBy("key")) \
        .applyInArrow(run, "g long, bits array<float>")


def _added(chunked: DataFrame, costs: DataFrame, langs: list[str], kind: str) -> DataFrame:
    """``(doc_id, bits)`` for every document, from its chunk's ``costs (chunk, g, bits)``; null without a letter."""
    def run(key, left, right):
        g = right.column("g").combine_chunks().to_numpy() if right.num_rows else np.empty(0, np.int64)
        bits = right.column("bits").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
        order = np.argsort(g)
        g, bits = g[order], bits[order].astype(np.float64)
        out = []
        for data in left.column("data").to_pylist():
            total = np.zeros(len(langs))
            for part in grams(zlib.decompress(data)) if data else ():
                at = np.searchsorted(g, part)
                if not np.array_equal(g[at], part):
                    raise RuntimeError("a gram of a text has no cost")
                total += np.bincount(at, minlength=len(g)) @ bits
            out.append(total.tolist() if data else None)
        return pa.table([left.column("doc_id"), pa.array(out, pa.list_(pa.float64()))], ["doc_id", "bits"])

    return chunked.groupBy("chunk").cogroup(costs.groupBy("chunk")).applyInArrow(run, f"doc_id {kind}, bits array<double>")


def code_bits(docs: DataFrame, training: DataFrame) -> tuple[DataFrame, list[str]]:
    """``(doc_id, bits)``, one entry of ``bits`` for each language learned from ``training (lang, text)``, and these languages, sorted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    trees = written(gram_counts(training), "trees")
    pairs = trees.groupBy("lang", F.col("g").bitwiseAND(F.lit(65535)).alias("pair")).agg(F.sum("c").alias("c")).collect()
    langs = sorted({r["lang"] for r in pairs})
    low = np.zeros((len(langs), 256, 256))
    for r in pairs:
        low[langs.index(r["lang"]), r["pair"] >> 8, r["pair"] & 255] = r["c"]
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunked = _chunks(docs, max(1, -(-size // CHUNK_BYTES)))
    # one exchange of the texts, and one of the questions, serve both of their uses
    asked = _asked(chunked).repartition("g")
    wanted = asked.groupBy("g").agg(F.max("chunk")).select("g")
    costs = asked.join(_costs(wanted, trees, langs, low), "g").select("chunk", "g", "bits")
    return _added(chunked, costs, langs, kind), langs


def identify(docs: DataFrame) -> DataFrame:
    """Query ``op13_ppm_language``: ``doc_id, held_out, lang_pred, score`` for every document.

    Learned from documents with a ``lang`` whose ``crc32(doc_id as text) mod 4`` is not 2 (a null
    doc_id is not held out). ``score`` is the language's share of 2 ** -bits over all languages, between 1 / their number and
    1; languages that code a text in equally many bits tie, and the first in order wins. Texts without a
    letter (null and empty ones, digits only) are ``und`` with score 0, as is everything when no document teaches a language.
    Case, digits, punctuation and white space play no part. Repeated rows each get their row; further columns are not read.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    scored, langs = code_bits(docs, docs.filter(~held & F.col("lang").isNotNull()))
    if not langs:
        return docs.select("doc_id", held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    best = F.array_min("bits")
    share = 1 / F.aggregate("bits", F.lit(0.0), lambda x, b: x + F.pow(F.lit(2.0), best - b))
    first = F.coalesce(*[F.when(F.col("bits")[i] == best, F.lit(k)) for i, k in enumerate(langs)])
    return scored.select("doc_id", held.alias("held_out"), F.when(F.col("bits").isNull(), F.lit(UNKNOWN)).otherwise(first).alias("lang_pred"),
                         F.when(F.col("bits").isNull(), F.lit(0.0)).otherwise(share).alias("score"))
