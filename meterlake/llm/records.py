"""Token ids in length-delimited binary record files with a separate offset index.

A record is framed as in the public record format of ML input pipelines: length (uint64),
masked checksum of the length, payload, masked checksum of the payload; all little-endian.
The checksum is CRC-32, masked by a rotation and a constant so that a checksum stored inside
checked data does not check itself. The payload is a header (record key, key present, bytes per
id) and the ids, in 2 bytes where the whole vocabulary fits.
The index of a file holds 16 bytes a record: its offset and its number of ids.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from meterlake.llm.common import written
from meterlake.llm.pieces import PieceCache
from meterlake.session import fresh_dir

# fixed values of the record format
MASK_DELTA = 0xA282EAD8
FRAME = struct.Struct("<QI")
HEADER = struct.Struct("<q?B")
END_ID = 0
BUFFER = 4 << 20
#: Pieces held by a worker: about 250 MB.
HELD = 1_200_000
#: Pieces encoded as lines of one text.
LINES = 2000
#: Texts cut and encoded together.
TOGETHER = 1024
#: Records that a shuffled read fetches together, in the order of their places.
READ_TOGETHER = 512


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def read_frame(stream) -> bytes | None:
    """The next record's payload, None at the end; raises ValueError on a damaged record."""
    head = stream.read(FRAME.size)
    if not head:
        return None
    if len(head) < FRAME.size:
        raise ValueError("record cut off in its length")
    length, check = FRAME.unpack(head)
    if masked_crc(head[:8]) != check:
        raise ValueError("record length fails its checksum")
    payload, tail = stream.read(length), stream.read(4)
    if len(payload) < length or len(tail) < 4 or struct.unpack("<I", tail)[0] != masked_crc(payload):
        raise ValueError("record fails its checksum")
    return payload


def pack(key: int | None, ids: bytes, width: int) -> bytes:
    body = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids
    return HEADER.pack(key or 0, key is not None, width) + body


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, present, width = HEADER.unpack_from(payload)
    return key if present else None, np.frombuffer(payload, f"<u{width}", offset=HEADER.size).astype("<u4")


def filesystem(base: str):
    """(file system, path) of a folder: any store that pyarrow reaches by uri, or a local path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)


@lru_cache(maxsize=2)
def _cache(tokenizer: str) -> tuple[PieceCache, int]:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer)
    special = [t.content for t in lib.get_added_tokens_decoder().values()]
    border = lib.encode("\n", add_special_tokens=False).ids

    # without white space inside: a line break before or after stays a token by itself
    single = re.compile(" ?(?!.*(?:" + "|".join(map(re.escape, special)) + r"))\S+" if special else r" ?\S+").fullmatch

    def one_by_one(texts: list[str]) -> Iterator[tuple[str, bytes]]:
        for t, e in zip(texts, lib.encode_batch_fast(texts, add_special_tokens=False)):
            yield t, np.array(e.ids, "<u4").tobytes()

    def by_line(texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Encoded as lines of one text, which saves the library's work for each text."""
        ids = np.array(lib.encode_batch_fast(["\n".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == border[0]) * 4
        if len(ends) != len(texts) - 1:
            raise ValueError("a line break is not a token by itself between pieces")
        raw = ids.tobytes()
        return zip(texts, (raw[i:j] for i, j in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)])))

    def encode(texts: list[str]) -> Iterator[bytes]:
        lines = [t for t in texts if single(t)] if len(border) == 1 else []
        ids = dict(chain.from_iterable(by_line(lines[lo:lo + LINES]) for lo in range(0, len(lines), LINES)))
        ids.update(one_by_one([t for t in texts if t not in ids]))
        return map(ids.__getitem__, texts)

    return PieceCache(encode, HELD, special=special), 2 if lib.get_vocab_size() <= 1 << 16 else 4


def write_records(docs: DataFrame, tokenizer: str, base: str, key: str = "doc_id") -> DataFrame:
    """Write ``docs`` in ascending key order; one manifest row per file, in file order.

    Files have a name of their own for each task attempt, and the manifest, itself a written
    table, names those of the attempts that counted: a lost executor leaves unnamed files at
    most. Null keys come first; rows with one key are ordered by their text's hash. A null
    text is an empty one: its record holds the end id only. An empty table gives an empty
    manifest. Special tokens written in a text become their ids, as the library as loaded does.
    Raises TypeError where the key is no integer, the only kind that a record's header holds.
    """
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} must be an integer, not {docs.schema[key].dataType.simpleString()}")

    def run(batches):
        store, folder = filesystem(base)
        cache, width = _cache(tokenizer)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        end = struct.pack("<I", END_ID)
        records = tokens = offset = 0
        out = None
        index = []
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                keys = batch.column(0)[lo:lo + TOGETHER].to_pylist()
                for k, ids in zip(keys, cache.ids([t or "" for t in batch.column(1)[lo:lo + TOGETHER].to_pylist()])):
                    if out is None:
                        out = store.open_output_stream(f"{folder}/{name}.rec", buffer_size=BUFFER)
                    data = frame(pack(k, ids + end, width))
                    out.write(data)
                    index.append(struct.pack("<QQ", offset, len(ids) // 4 + 1))
                    offset, records, tokens = offset + len(data), records + 1, tokens + len(ids) // 4 + 1
        if out is not None:
            out.close()
            with store.open_output_stream(f"{folder}/{name}.idx") as f:
                f.write(b"".join(index))
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "records": records, "tokens": tokens, "bytes": offset}])

    ordered = docs.select(key, "text").repartitionByRange(F.col(key).asc(), F.xxhash64("text")) \
        .sortWithinPartitions(F.col(key).asc(), F.xxhash64("text"))
    manifest = written(ordered.mapInArrow(run, "part long, file string, records long, tokens long, bytes long"), "manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).cast("long"))


def read_records(manifest: DataFrame, base: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every record, read from the files and checked."""
    def run(batches):
        store, folder = filesystem(base)
        for batch in batches:
            for row in batch.to_pylist():
                start, rows = row["start"], []
                with store.open_input_stream(f"{folder}/{row['file']}.rec", buffer_size=BUFFER) as stream:
                    while (payload := read_frame(stream)) is not None:
                        k, ids = unpack(payload)
                        rows.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 4096:
                            yield _rows(rows, key)
                            rows = []
                if rows:
                    yield _rows(rows, key)

    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(run, f"{key} long, start long, n_tokens long, ids_crc32 long")


def _rows(rows, key):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [key, "start", "n_tokens", "ids_crc32"])


def read_shuffled(manifest: DataFrame, base: str, seed: int) -> DataFrame:
    """All records as ``key long, ids array<int>`` in an order drawn from ``seed``: the index gives
    each record's place; a few hundred records at a time are read in the order of their places."""
    def places(batches):
        store, folder = filesystem(base)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{folder}/{row['file']}.idx") as f:
                    at = np.frombuffer(f.read(), "<u8").reshape(-1, 2)[:, 0].astype("int64")
                yield pa.RecordBatch.from_arrays([pa.array([row["file"]] * len(at)), pa.array(at)], ["file", "offset"])

    def fetch(batches):
        store, folder = filesystem(base)
        for batch in batches:
            for lo in range(0, batch.num_rows, READ_TOGETHER):
                rows = batch.slice(lo, READ_TOGETHER).to_pylist()
                got = [None] * len(rows)
                by_place = sorted(range(len(rows)), key=lambda i: (rows[i]["file"], rows[i]["offset"]))
                for file, run in groupby(by_place, key=lambda i: rows[i]["file"]):
                    with store.open_input_file(f"{folder}/{file}.rec") as f:
                        for i in run:
                            f.seek(rows[i]["offset"])
                            got[i] = unpack(read_frame(f))
                keys, ids = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([x.astype("int32") for x in ids], pa.list_(pa.int32()))], ["key", "ids"])

    order = F.xxhash64(F.lit(seed), "file", "offset")
    return manifest.mapInArrow(places, "file string, offset long").repartitionByRange(order).sortWithinPartitions(order) \
        .mapInArrow(fetch, "key long, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Contract of ``op8_records``: write the token ids of ``documents`` and return what the files hold."""
    base = fresh_dir(docs.sparkSession, "records")
    return read_records(write_records(docs, tokenizer, base), base)
