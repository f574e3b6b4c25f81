"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The merges of one pre-token are a priority queue over ranks: a bucket per rank holds the
linked-list positions whose pair has that rank, and a two-level bitmap marks the ranks whose
bucket is not empty, so find-first-set gives the next rank in constant time. A merge changes
two neighbouring pairs, which go into their own buckets; their old entries stay and are
skipped when they come up. Cost per pre-token of n bytes is O(n log n) at most, also for a
text of millions of bytes without a border.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.pieces import PieceCache

#: log2 of the ranks a word of the bitmap holds, and room for an id in a pair's key.
BITS, SHIFT = 8, 24
MASK = (1 << BITS) - 1
#: Pre-tokens held by a worker, and the characters of the longest one held.
HELD, LONGEST = 1_200_000, 100


class Merges(NamedTuple):
    """A vocabulary as the queue needs it."""

    ranks: dict[bytes, int]
    single: list[int]        # id of each byte
    pairs: dict[int, int]    # left id << SHIFT | right id -> id of the merged token


def merges(ranks: dict[bytes, int]) -> Merges:
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << SHIFT | right] = rank
    return Merges(ranks, [ranks[bytes([b])] for b in range(256)], pairs)


def encode_bytes(token: bytes, vocabulary: Merges) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals.

    The queue lives in local names (``buckets``, ``low``, ``high``), since most pre-tokens are
    a few bytes long and a call per step would cost more than the step.
    """
    whole = vocabulary.ranks.get(token)
    if whole is not None:
        return [whole]
    rank_of = vocabulary.pairs.get
    ids = list(map(vocabulary.single.__getitem__, token))
    n = len(ids)
    current = [rank_of(a << SHIFT | b) for a, b in pairwise(ids)]  # rank of the pair that starts here
    current.append(None)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    buckets: dict[int, list[int]] = {}  # rank -> heap of positions
    low: dict[int, int] = {}            # word of ranks -> bits of those whose bucket is not empty
    high = 0                            # bits of the words that are not zero
    fresh = [(rank, i) for i, rank in enumerate(current) if rank is not None]
    while True:
        for rank, i in fresh:
            bucket = buckets.get(rank)
            if bucket:
                heappush(bucket, i)
            else:
                buckets[rank] = [i]
                word = rank >> BITS
                low[word] = low.get(word, 0) | 1 << (rank & MASK)
                high |= 1 << word
        if not high:
            break
        word = (high & -high).bit_length() - 1
        bits = low[word]
        rank = word << BITS | (bits & -bits).bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            low[word] = bits = bits & bits - 1
            if not bits:
                high &= high - 1
        fresh = []
        if current[i] != rank:
            continue  # stale: the pair has changed or gone
        j = after[i]
        k = after[i] = after[j]
        ids[i], ids[j], current[j] = rank, -1, None
        new = None
        if k < n:
            before[k] = i
            new = rank_of(rank << SHIFT | ids[k])
            if new is not None:
                fresh.append((new, i))
        current[i] = new
        h = before[i]
        if h >= 0:
            current[h] = new = rank_of(ids[h] << SHIFT | rank)
            if new is not None:
                fresh.append((new, h))
    return [x for x in ids if x >= 0]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> tuple[PieceCache, list[bytes]]:
    """Per worker: the piece cache over the rank queue, and the bytes of each id."""
    import regex
    ranks = load_ranks(path)
    vocabulary = merges(ranks)
    find = regex.compile(pattern).findall

    known: dict[str, bytes] = {}

    def ids_of(token: str) -> bytes:
        ids = encode_bytes(token.encode(), vocabulary)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= LONGEST:
            known[token] = packed
        return packed

    def encode(texts: list[str]) -> Iterator[bytes]:
        if len(known) > HELD:
            known.clear()
        for text in texts:
            yield b"".join([known.get(token) or ids_of(token) for token in find(text)])

    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return PieceCache(encode), tokens


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes that little-endian uint32 ``ids`` stand for."""
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, the
    little-endian uint32 ids, if ``with_ids``).

    ``path`` names the rank file, which lies on every worker. Whole texts are encoded, each
    match of ``pattern`` by itself, without special tokens; the ids are decoded again for
    ``decoded_sha256``. A null text is an empty one (no ids). Repeated documents give a row
    each; columns other than ``doc_id`` and ``text`` are ignored. Nothing is shuffled.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def run(batches):
        cache, tokens = _codec(path, pattern)
        for batch in batches:
            column = batch.column(1)
            for lo in range(0, batch.num_rows, 128):
                texts = [t or "" for t in column[lo:lo + 128].to_pylist()]
                ids = cache.ids(texts)
                out = [batch.column(0)[lo:lo + 128],
                       pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                       pa.array([hashlib.sha256(decode(x, tokens)).hexdigest() for x in ids])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out, names = [*out, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
