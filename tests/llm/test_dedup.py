import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from meterlake.llm import minhash, repeats
from meterlake.llm.common import components
from tests.llm.conftest import with_clashes


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_against_the_full_table():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 7)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = [rng.randint(0, 6)] * rng.randint(0, 1)
        if rng.random() < 0.2:
            b = [rng.randint(0, 6) for _ in range(rng.randint(0, 25))]
        d, most = edit_distance(a, b), rng.randint(0, 12)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert minhash.banded_distance(x, y, most) == (d if d <= most else None)
        if a or b:
            assert minhash.similar(x, y) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def test_sketch_depends_on_order_and_repeats():
    hashes = minhash.WordHashes()
    a = minhash.words("one two three four five six seven eight nine ten " * 3, hashes)
    assert (minhash.sketch(minhash.kmers(a)) == minhash.sketch(minhash.kmers(a.copy()))).all()
    assert len(set(minhash.kmers(a).tolist())) == len(minhash.kmers(a))  # occurrences are told apart
    b = np.concatenate([a[15:], a[:15]])
    assert (minhash.sketch(minhash.kmers(a)) == minhash.sketch(minhash.kmers(b))).mean() < 1


def classes_by_force(rows):
    hashes = minhash.WordHashes()
    seqs = [minhash.words(t, hashes) for _, t, *_ in rows]
    of = list(range(len(rows)))
    for i, a in enumerate(seqs):
        for j in range(i):
            if len(a) and len(seqs[j]) and minhash.similar(a, seqs[j]) or rows[i][:2] == rows[j][:2]:
                of = [of[j] if x == of[i] else x for x in of]
    ids = {}
    for (i, *_), c in zip(rows, of):
        ids[c] = min((x for x in (i, ids.get(c)) if x is not None), default=None)
    return sorted(((i, ids[c]) for (i, *_), c in zip(rows, of)), key=str)


def test_classes_of_odd_documents(odd_docs, odd_rows, no_docs):
    assert sorted(map(tuple, minhash.near_duplicates(odd_docs).collect()), key=str) == classes_by_force(odd_rows)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_class_stays(odd_docs, odd_rows, no_docs):
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {c for _, c in classes_by_force(odd_rows) if c is not None} | {None}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)
    assert minhash.keep_one(no_docs).count() == 0


def test_families_chains_and_shared_passages(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, passage = [], [word() for _ in range(40)]
    for family in range(6):
        base = [word() for _ in range(80)] + passage * (family % 2)
        for copy in range(12):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, " ".join(passage + [word() for _ in range(60)])) for i in range(30)]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()), key=str)
    assert got == classes_by_force(rows)


def test_a_repeat_in_one_text_only(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    long, short = [word() for _ in range(60)], [word() for _ in range(8)]
    hashes = minhash.WordHashes()
    once, twice = (minhash.kmers(minhash.words(" ".join(t), hashes)) for t in (long, long + long[:6]))
    assert set(once.tolist()) <= set(twice.tolist())
    once, twice = (np.unpackbits(minhash.bitmap(minhash.words(" ".join(t), hashes)).view(np.uint8)) for t in (short, short + short[-1:]))
    assert (once <= twice).all()
    rows = [(i, " ".join(t)) for i, t in enumerate((long, long + long[:6], short, short + short[-1:], [word() for _ in range(30)]))]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == classes_by_force(rows) and len({c for _, c in got}) == 3


def test_candidates_down_to_the_least_similarity():
    rng = random.Random(8)
    hashes = minhash.WordHashes()
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(60)]
    keys = lambda w: set(np.concatenate([minhash.sketch(minhash.kmers(w)), minhash.prefix(w)]).tolist())
    seen = 0
    for n in list(range(4, 40)) * 20:  # short texts: every pair
        a = [rng.choice(vocabulary) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(1, max(1, n // 5))):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
        x, y = (minhash.words(" ".join(t), hashes) for t in (a, b))
        if len(y) and minhash.similar(x, y):
            seen += 1
            assert keys(x) & keys(y)
    assert seen > 300
    for rate, least in ((0.1, 0.99), (0.15, 0.97), (0.19, 0.85)):  # long texts: measured recall
        found = 0
        for _ in range(200):
            a = [rng.getrandbits(63) for _ in range(400)]
            b = list(a)
            for at in rng.sample(range(400), int(400 * rate)):
                b[at] = rng.getrandbits(63)
            found += bool(keys(np.array(a, np.uint64)) & keys(np.array(b, np.uint64)))
        print(rate, found / 200)
        assert found >= 200 * least


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7), (500, 500)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats_by_force(rows, width):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[i:i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for (i, *_), b in zip(rows, data):
        gone = [False] * len(b)
        for at in range(len(b) - width + 1):
            if seen[b[at:at + width]] > 1:
                gone[at:at + width] = [True] * width
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("unit", [repeats.Unit("bytes", 20, 4, (8, 2)), repeats.Unit("bytes", 40, 8, (8, 4)), repeats.BYTES_400])
def test_repeated_bytes(spark, unit):
    rng, width = random.Random(unit.width), unit.width
    bases = ["".join(rng.choice("abé ") for _ in range(rng.randint(width, 4 * width))) for _ in range(5)]
    rows = []
    for i in range(40):
        text = ""
        for _ in range(rng.randint(1, 4)):
            base = rng.choice(bases)
            at = rng.randrange(len(base))
            text += base[at:at + rng.randint(1, 2 * width)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, width)))
        rows.append((i, text))
    rows += [(60, None), (61, ""), (62, "a" * 3 * width), (63, rows[0][1]), (5, rows[5][1]), (64, "q" * (width - 1)), (65, "q" * width), (None, rows[2][1])]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, repeats.byte_report(docs, unit).collect()), key=str) == repeats_by_force(rows, width)


def test_odd_documents_bytes(odd_docs, odd_rows, no_docs):
    assert sorted(map(tuple, repeats.byte_report(odd_docs).collect()), key=str) == repeats_by_force(odd_rows, 400)
    assert repeats.byte_report(no_docs).count() == 0


def test_long_texts_are_handled_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 3, n).astype(np.uint8) for n in (5000, 399, 0, 400, 3000, 12_000)]

    def windows():
        owner = {}
        for of, g, place, first, last in repeats.runs(texts, repeats.BYTES_400):
            for i, x, p, a, b in zip(of.tolist(), g.tolist(), place.tolist(), first.tolist(), last.tolist()):
                for w in range(a, b + 1):
                    assert (i, w) not in owner and 0 <= p - w <= 352
                    owner[i, w] = (x, p)
        return owner

    whole = windows()
    assert len(whole) == sum(max(0, len(t) - 399) for t in texts)
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    assert windows() == whole


def test_repeated_words_are_cut(odd_docs, odd_rows, no_docs):
    cut = repeats.remove_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == len(odd_rows)
    got = {}
    for r in cut.collect():
        got.setdefault(r["doc_id"], r["text"])
    texts = {i: t for i, t, *_ in reversed(odd_rows)}
    words = {i: (t or "").split() for i, t in texts.items()}
    seen = Counter(tuple(w[i:i + 50]) for w in ((t or "").split() for _, t, *_ in odd_rows) for i in range(len(w) - 49))
    for i, w in words.items():
        gone = [False] * len(w)
        for at in range(len(w) - 49):
            if seen[tuple(w[at:at + 50])] > 1:
                gone[at:at + 50] = [True] * 50
        assert (got[i] or "").split() == [x for x, g in zip(w, gone) if not g]
        if not any(gone):
            assert got[i] == texts[i]
    assert got[14] == "" and "." in got[10]
    assert repeats.remove_repeats(no_docs).count() == 0


def test_words_of_ascii_and_other_texts_are_those_of_the_pattern():
    hashes = minhash.WordHashes()
    for text in ("".join(map(chr, range(128))), "It's snake_case, x2 --\tA\x1cB\n", "Grüße, İstanbul x", "", None):
        assert minhash.words(text, hashes).tolist() == [hashes[w] for w in minhash._WORD.findall((text or "").lower())]


def test_blocks_keep_exactly_the_pairs_that_the_bounds_allow():
    rng = random.Random(8)
    base = [[rng.getrandbits(62) for _ in range(rng.randint(1, 60))] for _ in range(6)]
    seqs = []
    for _ in range(60):
        seq = list(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            seq[rng.randrange(len(seq))] = rng.getrandbits(62)
        seqs.append(np.array(seq + seq[:1] * rng.randint(0, 5), np.uint64))
    n, classes, bits = np.array([len(s) for s in seqs], np.int32), np.arange(60) % 7, np.stack([minhash.bitmap(s) for s in seqs])
    got = set(zip(*map(np.ndarray.tolist, minhash.close(n[:25], classes[:25], bits[:25], n, classes, bits))))
    on = np.unpackbits(bits.view(np.uint8), axis=1).astype(int)
    for i in range(25):
        for j in range(60):
            most = int(0.2 * max(n[i], n[j]) + 1e-9)
            lost = max((on[i] & ~on[j] & 1).sum(), (on[j] & ~on[i] & 1).sum())
            assert ((i, j) in got) == (classes[i] != classes[j] and min(n[i], n[j]) >= max(n[i], n[j]) - most and lost <= most), (i, j)


def test_a_family_of_copies_aligns_about_one_pair_a_text(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(5):
            text[rng.randrange(120)] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    tried, real = [], minhash._verified
    monkeypatch.setattr(minhash, "_verified", lambda pairs, texts: (tried.append(pairs.count()), real(pairs, texts))[1])
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}
    assert sum(tried) <= 60 * 1.5


def bucket_of_unlike_texts(count, length, seed):
    """Texts of one passage each that share buckets, and copies of some of them with two words changed."""
    rng = random.Random(seed)
    passage, rows = [f"p{i}" for i in range(length // 3)], []
    for i in range(count):
        rows.append((2 * i, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(length - length // 3)])))
        if i % 4 == 0:
            copy = rows[-1][1].split()
            copy[-1] = copy[-9] = f"y{i}"
            rows.append((2 * i + 1, " ".join(copy)))
    return rows


def test_a_bucket_of_many_words_is_not_copied_block_by_block(spark, monkeypatch):
    rows, seen, real = bucket_of_unlike_texts(40, 6000, 2), [], minhash._close_in_blocks
    monkeypatch.setattr(minhash, "_close_in_blocks", lambda members, groups: (seen.append(members), real(members, groups))[1])
    got = {i: c for i, c in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    blocks = seen[0].groupBy("key").agg({"few": "max", "all": "max", "node": "count"}).collect()
    assert max(b["count(node)"] for b in blocks) >= 30
    assert all(b["max(few)"] <= 1 and b["max(all)"] == 1 for b in blocks)  # a text is sent once a bucket


@pytest.mark.parametrize("minor, every, part", [(2_000, 8_000, 500_000), (7, 11, 100), (1, 2, 1)])
def test_pairs_of_blocks_are_taken_once_whatever_their_size(spark, monkeypatch, minor, every, part):
    rng = random.Random(6)
    base = [[rng.getrandbits(62) for _ in range(rng.randint(20, 40))] for _ in range(3)]
    texts, keys = [], (-5, 3, 2**62)
    for i in range(36):
        seq = list(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            seq[rng.randrange(len(seq))] = rng.getrandbits(62)
        texts.append((i, np.array(seq, np.uint64), rng.randrange(12), rng.sample(keys, rng.randint(1, 3))))
    rows = []
    for key in keys:
        held = [t for t in texts if key in t[3]]
        main = Counter(t[2] for t in held).most_common(1)[0][0]
        few, every_block = -(-sum(t[2] != main for t in held) // minor), -(-len(held) // every)
        rows += [(key, i, len(seq), comp, comp != main, of, bytearray(zlib.compress(minhash.bitmap(seq).tobytes())), few, every_block) for i, seq, comp, of in held]
    monkeypatch.setattr(minhash, "PAIR_WORDS", part)
    members = spark.createDataFrame(rows, "key long, node long, n int, comp long, minor boolean, keys array<long>, bits binary, few long, all long")
    got = minhash._close_in_blocks(members, 3).collect()
    want = set()
    for i, x, cx, kx in texts:
        for j, y, cy, ky in texts[:i]:
            sides = [(np.array([len(s)], np.int32), np.array([c]), minhash.bitmap(s)[None, :]) for s, c in ((x, cx), (y, cy))]
            if set(kx) & set(ky) and len(minhash.close(*sides[0], *sides[1])[0]):
                want.add((j, i, min(set(kx) & set(ky))))
    assert len(want) > 20
    assert sorted((min(r["a"], r["b"]), max(r["a"], r["b"]), r["key"]) for r in got) == sorted(want)
    # a text outside the largest class is in one part of its block; parts stay near their words
    assert len({(r["key"], r["ab"], r["bb"], r["part"], r["a"]) for r in got}) == len({(r["key"], r["ab"], r["bb"], r["a"]) for r in got})
    if part == 1:
        assert len({(r["key"], r["ab"], r["bb"], r["part"]) for r in got}) == len({(r["key"], r["ab"], r["bb"], r["a"]) for r in got})
