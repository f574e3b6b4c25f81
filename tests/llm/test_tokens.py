import hashlib
import io
import random
import struct
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterlake.llm import bpe, records
from meterlake.llm.pieces import pieces

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
HARD = ["", " ", "  two  spaces ", "\n x\n\ny \n", "it's we'll I'd", "a" * 2000, "日本語 テキスト 123", "<|endoftext|> x", "　a  b", "x \ny", "\t \t a"]


@lru_cache
def _tiktoken():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def reference():
    return _tiktoken()


@lru_cache
def _library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def library():
    return _library()


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


@pytest.mark.parametrize("text", HARD)
def test_pieces_join_to_the_text(text):
    assert "".join(pieces(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\tab1'é!.日"), max_size=60))
def test_bpe_matches_the_library(text):
    cache, tokens = bpe._codec(RANKS, P.PATTERN)
    ids, = cache.ids([text])
    assert unpacked(ids) == _tiktoken().encode_ordinary(text)
    assert bpe.decode(ids, tokens) == text.encode()


def test_hard_texts(reference, library):
    cache, tokens = bpe._codec(RANKS, P.PATTERN)
    for text, ids in zip(HARD, cache.ids(HARD)):
        assert unpacked(ids) == reference.encode_ordinary(text)
        assert bpe.decode(ids, tokens) == text.encode()
    cache, _ = records._cache(JSON)
    for text, ids in zip(HARD, cache.ids(HARD)):
        assert unpacked(ids) == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_as_the_library_loads_them(library):
    cache, _ = records._cache(JSON)
    assert unpacked(cache.ids(["a<|endoftext|>b"])[0]) == library.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", " ", "\n", "\t", "\x1c", "\x85", "\u3000", "a", "b1", "'s", "é!", "日", "<|endoftext|>", "<|"]), max_size=40))
def test_records_match_the_library(parts):
    cache, _ = records._cache(JSON)
    texts = ["".join(parts), "".join(reversed(parts)), " ".join(parts)]
    for text, ids in zip(texts, cache.ids(texts)):
        assert unpacked(ids) == _library().encode(text, add_special_tokens=False).ids


def test_a_key_that_is_no_integer_is_refused(spark, workdir):
    with pytest.raises(TypeError):
        records.write_records(spark.createDataFrame([("a", "b")], "doc_id string, text string"), JSON, workdir)


def test_very_long_pre_token(reference):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdth") for _ in range(20_000))
    vocabulary = bpe.merges(bpe.load_ranks(RANKS))
    assert bpe.encode_bytes(text.encode(), vocabulary) == reference.encode_ordinary(text)


def test_query_rows(spark, odd_docs, odd_rows, no_docs, reference):
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(odd_docs, RANKS, P.PATTERN).collect())
    want = []
    for i, t, *_ in odd_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i or -1, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_documents(no_docs, RANKS, P.PATTERN).count() == 0


def test_frames():
    payload = records.pack(7, struct.pack("<3I", 5, 6, 50_000), 2)
    data = records.frame(payload) + records.frame(b"")
    stream = io.BytesIO(data)
    assert records.read_frame(stream) == payload and records.read_frame(stream) == b"" and records.read_frame(stream) is None
    key, ids = records.unpack(payload)
    assert key == 7 and ids.tolist() == [5, 6, 50_000]
    assert records.unpack(records.pack(None, b"", 4))[0] is None
    for at in (0, 9, 14, len(payload) + 13):
        broken = bytearray(records.frame(payload))
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(data[:5]))


def test_record_files(spark, odd_docs, odd_rows, no_docs, library, workdir):
    manifest = records.write_records(odd_docs, JSON, workdir)
    rows = sorted(records.read_records(manifest, workdir).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, *_ in odd_rows), key=lambda x: (x is not None, x))
    want = {}
    for i, t, *_ in odd_rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want[i] = (len(ids), zlib.crc32(ids.tobytes()))
    at = 0
    for r in rows:
        assert (r["n_tokens"], r["ids_crc32"]) == want[r["doc_id"]] and r["start"] == at
        at += r["n_tokens"]
    shuffled = records.read_shuffled(manifest, workdir, seed=3).collect()
    assert sorted((r["key"] or -1, len(r["ids"])) for r in shuffled) == sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rows)
    empty = records.write_records(no_docs, JSON, workdir)
    assert records.read_records(empty, workdir).count() == 0
