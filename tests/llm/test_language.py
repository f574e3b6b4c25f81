import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterlake.llm import language
from meterlake.llm.catalog import QUERIES


class Tree:
    """PPM with exclusion by method C, told byte by byte."""

    def __init__(self, texts):
        self.followed = defaultdict(Counter)
        for data in texts:
            data = b" " * language.ORDER + data
            for i in range(language.ORDER, len(data)):
                for k in range(language.ORDER + 1):
                    self.followed[data[i - k:i]][data[i]] += 1

    def probability(self, context, byte):
        p, excluded = 1.0, set()
        for k in range(language.ORDER, -1, -1):
            here = self.followed.get(context[language.ORDER - k:])
            if not here:
                continue
            free = {s: c for s, c in here.items() if s not in excluded}
            room = sum(free.values()) + len(free)
            if byte in free:
                return p * free[byte] / room
            if free:
                p *= len(free) / room
            excluded |= set(here)
        return p / (256 - len(excluded))

    def bits(self, data):
        data = b" " * language.ORDER + data
        return -sum(math.log2(self.probability(data[i - language.ORDER:i], data[i])) for i in range(language.ORDER, len(data)))


def test_normal_text():
    assert language.normal("Ab1c, d_É!\n") == " ab c d é ".encode()
    assert language.normal(None) == language.normal("") == language.normal("12 _ 3!") == b""


def test_grams_of_long_texts_come_in_slices(monkeypatch):
    data = bytes(range(97, 117)) * 3
    whole = np.concatenate(list(language.grams(data)))
    monkeypatch.setattr(language, "SLICE", 7)
    assert np.array_equal(np.concatenate(list(language.grams(data))), whole)
    assert [int(g) & 255 for g in whole] == list(data) and int(whole[0]) >> 8 == int.from_bytes(b"    ", "big")


def test_code_lengths_equal_the_tree_and_sum_to_one():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["ab", "abc", "cab", "été", "b"]) for _ in range(30)).encode() for _ in range(4)]
    tree = Tree(texts)
    seen, counts = language._grouped(np.concatenate([g for t in texts for g in language.grams(t)]), np.ones(sum(map(len, texts))))
    low = np.zeros((256, 256))
    np.add.at(low, ((seen >> 8) & 255, seen & 255), counts)
    for context in (b"    ", b" abc", b"zabc", b"zzab", b"zzzb", b"zzzz", "été".encode()[-4:]):
        asked = np.array([int.from_bytes(context, "big") << 8 | s for s in range(256)])
        bits = language.code_lengths(asked, seen, counts, low)
        assert abs((2 ** -bits).sum() - 1) < 1e-9
        assert np.abs(bits - [-math.log2(tree.probability(context, s)) for s in range(256)]).max() < 1e-9
        near = (seen >> 8 & 65535) == int.from_bytes(context[-2:], "big")  # what a group holds is enough
        assert np.array_equal(bits, language.code_lengths(asked, seen[near], counts[near], low))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def brute(rows):
    """rows of (doc_id, text, lang)"""
    by_lang = defaultdict(list)
    for i, text, lang in rows:
        if lang is not None and not held(i) and language.normal(text):
            by_lang[lang].append(language.normal(text))
    trees = {lang: Tree(texts) for lang, texts in sorted(by_lang.items())}
    out = []
    for i, text, _ in rows:
        data = language.normal(text)
        if not data or not trees:
            out.append((i, held(i), "und", 0.0))
            continue
        bits = {lang: tree.bits(data) for lang, tree in trees.items()}
        best = min(bits, key=lambda k: (bits[k], k))
        out.append((i, held(i), best, 1 / sum(2 ** (bits[best] - b) for b in bits.values())))
    return out


def same(df, rows):
    got = sorted(map(tuple, df.collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert all(abs(a[3] - b[3]) < 1e-3 for a, b in zip(got, want))


@pytest.mark.parametrize("chunk", [500, 32_000_000])
def test_identify_equals_brute_force(spark, monkeypatch, chunk):
    """Many chunks or one; short, mixed and foreign texts, some in a script that was never seen."""
    monkeypatch.setattr(language, "CHUNK_BYTES", chunk)
    rng = random.Random(7)
    words = {"en": ["the", "and", "ing", "thing", "with"], "fr": ["le", "été", "que", "eaux", "thé"], "de": ["und", "der", "schön", "ing"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(1, 12))), k) for i in range(60) for k in [rng.choice("en fr de".split())]]
    rows += [(100, "日本語", None), (101, "the été und", None), (102, "x", "de"), (103, "THE AND!", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    same(language.identify(df), rows)


def test_odd_documents(spark, odd_docs, odd_rows):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    same(language.identify(odd_docs), [r[:3] for r in odd_rows])


def test_nothing_to_learn(spark, no_docs):
    assert language.identify(no_docs).collect() == []
    rows = [(1, "some text", None), (2, None, "en"), (3, "12", "en")]
    same(language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")), rows)


def test_texts_move_once(spark):
    """The exchange of the texts, and that of the questions, serve both of their uses."""
    df = QUERIES["op13_ppm_language"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = QUERIES["op13_ppm_language"](spark, d).collect()
    assert len(got) == len(truth)
    assert all((r["lang_pred"] == "und") == (not language.normal(truth[r["doc_id"]]["text"])) for r in got)
    tried = [r for r in got if r["held_out"] and truth[r["doc_id"]]["lang"] is not None]
    right = sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in tried)
    print(len(tried), right)
    assert right >= 0.98 * len(tried) > 100
