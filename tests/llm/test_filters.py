import hashlib
import re

import pytest

from meterlake.llm import decontaminate, quality, urls
from tests.llm.conftest import with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contamination_by_force(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for i, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if tuple(w[at:at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[tuple(w[at:at + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(odd_rows):
    w = odd_rows[0][1].split()
    return [(1, " ".join(w[10:40])), (2, "ONE"), (10, " ".join(w[30:45]) + " tail"), (3, None), (4, ""), (5, "...!"),
            (6, "two three"), (7, " ".join(w[100:104]).upper()), (1, " ".join(w[60:72])), (8, "É a " * 4), (9, "x" * 30000)]


@pytest.mark.parametrize("broadcast_rows", [decontaminate.BROADCAST_ROWS, 0])
def test_contamination(spark, odd_docs, odd_rows, items, no_docs, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast_rows)
    bench = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate.contamination(odd_docs, bench)
    assert sorted(map(tuple, got.collect()), key=str) == contamination_by_force(odd_rows, items)
    assert decontaminate.contamination(no_docs, bench).count() == 0
    none = decontaminate.contamination(odd_docs, bench.limit(0))
    assert none.filter("contaminated or n_hit > 0").count() == 0 and none.count() == len(odd_rows)


def test_spans_and_documents_go(spark, odd_docs, odd_rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    cut = decontaminate.remove_spans(odd_docs, bench)
    assert cut.columns == odd_docs.columns and cut.count() == len(odd_rows)
    want = {(i, n): (hit, total) for i, total, hit, *_ in contamination_by_force(odd_rows, items) for n in [total]}
    texts = {i: t for i, t, *_ in odd_rows}
    for r in cut.collect():
        total = len(words(texts[r["doc_id"]]))
        hit, _ = want[r["doc_id"], total]
        assert len(words(r["text"])) == total - hit
        if not hit:
            assert r["text"] == texts[r["doc_id"]]
    whole = decontaminate.remove_spans(odd_docs, bench, whole_documents=True)
    assert whole.count() == sum(not hit for hit, _ in (want[i, len(words(t))] for i, t, *_ in odd_rows))


# ---- urls -------------------------------------------------------------------------------

def fit_by_force(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = host.translate(LOWER)
    best = None
    for action, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, action)
    return host, path, best


def rank_by_force(edges, seeds):
    start = {h: s * (1 - urls.DAMPING) for h, s in seeds.items()}
    rank = dict(start)
    for _ in range(300):
        new = dict(start)
        for (a, b), w in edges.items():
            if a in rank:
                new[b] = new.get(b, 0) + rank[a] * w * urls.DAMPING
        rank = new
    return rank


@pytest.mark.parametrize("name, seed, other", [("allow", "http://a.example.net/en/", "block"), ("block", "http://z.net/", "allow")])
def test_trust_and_distrust_go_to_the_end_of_a_chain(spark, name, seed, other):
    """A chain of 30 hosts that starts at an allowed host, or leads to a blocked one."""
    hosts = [f"http://h{i}.info/" for i in range(30)]
    chain = [seed, *hosts] if name == "allow" else [*hosts, seed]
    pages = [(i, u, f'<a href="{v}">x</a>') for i, (u, v) in enumerate(zip(chain, [*chain[1:], "/end"]))]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)).collect()
    score = {"allow": "trust", "block": "distrust"}[name]
    assert all(r[score] > 0 and r["verdict"] == name for r in got) and len(got) == 31
    far = max(r[score] for r in got) * urls.DAMPING ** 30
    assert abs(min(r[score] for r in got) / far - 1) < 1e-9


def test_urls_and_trust(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a><a href=/rel>y</a>' for h in hosts)
    pages = [(1, "http://a.example.net/en/1", link("good.info", "b.example.net")), (2, "http://b.example.net/de/1", link("a.example.net")),
             (3, "https://Good.INFO/x?q=http://net/", link("fine.info")), (4, "http://bad.info/", link("b.example.net", "spam.net")),
             (5, "http://spam.net/", link("bad.info", "spam.net")), (6, "http://fine.info#f", None), (7, None, link("good.info")),
             (8, "not a url", ""), (9, "http://www.example.com/de/x#y", ""), (10, "http://x.org/fr/", ""), (11, "http://x.org/fr", ""),
             (12, "http://net", ""), (13, "http://dannet/", ""), (14, "a://b://c/d", ""), (1, "http://a.example.net/en/1", link("good.info", "b.example.net"))]
    got = urls.judge(with_clashes(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()
    parts = {i: fit_by_force(u) for i, u, _ in pages}
    counts = {}
    for i, _, html in pages:
        for target in re.findall(r'href="http://([^/]*)/', html or ""):
            if parts[i][0] and target != parts[i][0]:
                counts[parts[i][0], target] = counts.get((parts[i][0], target), 0) + 1

    def weights(edges):
        return {e: n / sum(m for f, m in edges.items() if f[0] == e[0]) for e, n in edges.items()}

    edges = weights(counts)
    back = weights({(b, a): w for (a, b), w in edges.items()})
    seeds = {}
    for action in ("allow", "block"):
        own = {}
        for i, _, _ in pages:
            if parts[i][2] and parts[i][2][1] == action:
                own[parts[i][0]] = own.get(parts[i][0], 0) + 1
        seeds[action] = {h: n / sum(own.values()) for h, n in own.items()}
    trust, distrust = rank_by_force(edges, seeds["allow"]), rank_by_force(back, seeds["block"])
    assert len(got) == len(pages)
    for r in got:
        host, path, fit = parts[r["page_id"]]
        t, d = trust.get(host, 0), distrust.get(host, 0)
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit and fit[0])
        tail = urls.TOLERANCE * urls.DAMPING / (1 - urls.DAMPING)  # what may still be on its way
        assert r["trust"] == pytest.approx(t, abs=tail) and r["distrust"] == pytest.approx(d, abs=tail)
        assert r["verdict"] == (fit[1] if fit else "block" if d > 0.5 * (t + d) else "allow")
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert verdict[4] == "block" and verdict[3] == "allow" and verdict[6] == "allow"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- quality ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    judged = quality.classify(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id") \
        .join(docs.select("doc_id", "text"), "doc_id").toPandas()
    clean = judged[(judged.quality == 1) & (judged.toxic == 0)]
    assert len(clean) > 1000 and clean.keep.mean() > 0.998
    abuse = judged[judged.text.str.contains(r"\b(?:idiot|moron|scum|worthless|pathetic)\b", case=False)]
    assert len(abuse) > 50 and abuse.keep.mean() < 0.02
    assert judged[judged.quality == 0].keep.mean() < 0.4


def test_held_out_recall_by_kind(tables):
    docs, labels = tables
    judged = quality.classify(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id") \
        .join(docs.select("doc_id", "text"), "doc_id").toPandas()
    for lang, least in {"de": 0.9, "fr": 0.9, "es": 0.85, "en": 0.97}.items():
        toxic = judged[(judged.toxic == 1) & (judged.lang == lang)]
        assert len(toxic) > 10 and 1 - toxic.keep.mean() >= least
    doubled = judged.text.str.contains(r"\b(\w+)(?: \1\b){2}", case=False) & (judged.quality == 0)
    assert doubled.sum() > 50 and judged[doubled].keep.mean() < 0.05
    assert judged[(judged.quality == 1) & (judged.toxic == 0)].keep.mean() > 0.998


def test_rhythm_and_letters_of_any_script():
    numbers = quality.Numbers({"ключ": 2.0})
    assert quality.rhythm(numbers.of("a b A a c d b")).tolist() == [0, 0, 2, 1, 0, 0, 3]
    assert [numbers.ratios[n] for n in numbers.of("ключевой конь")] == [2.0, 0.0] and not len(quality.rhythm(numbers.of("")))


def test_kneser_ney_sums_to_one(spark):
    import numpy as np
    texts = spark.createDataFrame([(0, "the cat and the dog " * 20), (0, "A dog, a cat!"), (1, "zzz"), (0, None), (1, "")], "model long, text string")
    log_p, ratio = quality.dense(quality.compact(quality.train(texts)))
    p = np.exp(log_p.astype(np.float64)).reshape(-1, quality.SYMBOLS)
    assert np.abs(p.sum(1) - 1).max() < 0.01
    q = np.exp((log_p + ratio).astype(np.float64)).reshape(-1, quality.SYMBOLS)
    assert np.abs(q.sum(1) - 1).max() < 0.02


def test_odd_documents_and_labels(spark, odd_docs, odd_rows, no_docs):
    labels = with_clashes(spark.createDataFrame([(1, 1, 0), (12, 1, 0), (12, 1, 0), (13, 0, 1), (15, None, None), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int"))
    for chosen in (labels, labels.filter("toxic = 0"), labels.limit(0)):
        judged = quality.classify(odd_docs, chosen)
        rows = judged.collect()
        assert len(rows) == len(odd_rows)
        assert all(r["keep"] for r in rows if r["doc_id"] in (5, 6))
        assert all(r["keep"] for r in rows) or chosen is not None and chosen.count()
    assert quality.classify(no_docs, labels).count() == 0
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns
