"""Quality classifier: interpolated modified Kneser-Ney model of trusted text.

Texts are folded to a small alphabet (letters of either case, white space, letters beyond
ASCII, everything else) and modelled as n-grams of ORDER symbols. Two models are counted over
all labelled documents: one of trusted text (good quality, not toxic), one of toxic text. The
count tables are sharded by n-gram and turned into probabilities by joins: each order's
discounts come from its counts of counts, its lower order from the number of contexts a gram
was seen in, and a gram's probability joins its context's totals and its own shorter suffix.

The finished model has a bounded size whatever the corpus: at most SYMBOLS ** ORDER grams. The
seen ones are broadcast, so that scoring moves no text, and each worker lays them out as a
table of all grams once.

The whole document is scored for toxicity as well: the beginnings of words, letters of any script
kept apart, that are surely likelier in toxic text of its language give their mean log ratio. Words
that come again too soon show in a word model of trusted text: how long ago each word last
occurred, whatever the word. It has no context, in which a run of one word would foretell itself.

A document is rejected for its perplexity under the trusted model, for a word that is far likelier
in toxic text, for its mean ratio of word beginnings, or for the perplexity of its words' recurrence.
The limits come from quantiles of the trusted documents of its language.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import keyed, row_key, written

ORDER = 5
SPACE, LETTER, OTHER = 26, 27, 28
SYMBOLS = 29
#: Characters at the language's median that a score is averaged with, so that a text of three letters is no outlier.
PRIOR_CHARS = 20
#: A limit is q99 + FACTOR * (q99 - q50) of the language's trusted documents.
PERPLEXITY_FACTOR, TOXIC_FACTOR, ROOT_FACTOR, RHYTHM_FACTOR = 3.0, 1.5, 0.75, 1.0
#: Words without a ratio, and at the language's median, that the scores over words are averaged with.
ROOT_WORDS, RHYTHM_WORDS = 80, 10
#: Letters of the word beginnings, besides whole words, whose ratio is surely (by ROOT_ERRORS standard errors) above ROOT_RATIO.
ROOT_LETTERS = (2, 3, 4, 5, 6)
ROOT_RATIO, ROOT_ERRORS = 3.0, 3.0
#: Languages with fewer trusted documents share the limits of all of them.
LEAST_TRUSTED = 50
LONG_WORD = 16
#: Labelled documents up to which their ids are broadcast to the texts (16 MB); beyond it the join is shuffled.
BROADCAST_LABELS = 1_000_000

_FOLD = np.full(128, OTHER, np.uint8)
_FOLD[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = range(26)
_FOLD[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = range(26)
_FOLD[[ord(c) for c in " \t\n\r\f\v"]] = SPACE
MODELS = ("trusted", "toxic")
_WORD = re.compile(r"[^\W\d_]+")
STEPS = 32


def grams(text: str) -> np.ndarray:
    """The n-gram of ORDER symbols that ends at each character, as a number to base SYMBOLS."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    symbols = np.where(points < 128, _FOLD[np.minimum(points, 127)], LETTER).astype(np.int32)
    padded = np.concatenate([np.full(ORDER - 1, SPACE, np.int32), symbols])
    out = np.zeros(len(points), np.int32)
    for i in range(ORDER):
        out = out * SYMBOLS + padded[i:i + len(points)]
    return out


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Numbers(dict):
    """word -> its number in this task, and its ratio by ``roots``; emptied between texts when it grows past ``limit``."""

    limit = 400_000

    def __init__(self, roots: dict[str, float]):
        self.roots, self.ratios = roots, []

    def __missing__(self, word):
        n = self[word] = len(self.ratios)
        self.ratios.append(max([self.roots.get(b, 0.0) for b in beginnings(word)]) if self.roots else 0.0)
        return n

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.ratios.clear()
        return np.fromiter(map(self.__getitem__, words(text)), np.int64)


def beginnings(word: str) -> set[str]:
    return {word, *[word[:k] for k in ROOT_LETTERS if len(word) >= k]}


def rhythm(numbers: np.ndarray) -> np.ndarray:
    """A step for each word: 0 for the first time, else the bits of the distance to where it last occurred."""
    order = np.argsort(numbers, kind="stable")
    gap = np.zeros(len(numbers), np.int64)
    again = numbers[order][1:] == numbers[order][:-1]
    gap[order[1:][again]] = np.diff(order)[again]
    return np.minimum(np.frexp(gap.astype(np.float64))[1], STEPS - 1)


def step_costs(texts: DataFrame) -> np.ndarray:
    """The surprise of every step of ``rhythm`` in the ``texts (text)``; none costs anything without texts."""
    def run(batches):
        numbers, held = Numbers({}), np.zeros(STEPS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held += np.bincount(rhythm(numbers.of(text or "")), minlength=STEPS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(STEPS)), pa.array(held)], ["step", "c"])

    counts = np.zeros(STEPS)
    for r in texts.select("text").mapInArrow(run, "step long, c long").groupBy("step").agg(F.sum("c").alias("c")).collect():  # STEPS rows
        counts[r["step"]] = r["c"]
    return -np.log((counts + 1) / (counts.sum() + STEPS)) if counts.any() else counts


def toxic_roots(texts: DataFrame) -> dict[str, dict[str, float]]:
    """language -> word beginning -> log ratio toxic to trusted, for those surely above ROOT_RATIO.

    ``texts (language, model, text)``. Beginnings are counted and compared in Spark; only the
    ones found come to the driver.
    """
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512).to_pylist()
                held: dict[tuple, Counter] = {}
                for r in part:
                    held.setdefault((r["language"], r["model"]), Counter()).update(words(r["text"] or ""))
                rows = [(language, model, w, c) for (language, model), own in held.items() for w, c in own.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64()))],
                                                     ["language", "model", "word", "c"])

    counted = written(texts.select("language", "model", "text").mapInArrow(run, "language string, model long, word string, c long")
                      .groupBy("language", "word").agg(*[F.sum(F.when(F.col("model") == m, F.col("c")).otherwise(0)).alias(name) for m, name in enumerate(MODELS)]), "words")
    totals = counted.groupBy("language").agg(F.sum("trusted").alias("all_trusted"), F.sum("toxic").alias("all_toxic")).filter("all_trusted > 0 and all_toxic > 0")
    begins = [F.when(F.char_length("word") >= k, F.substring("word", 1, k)).otherwise(F.col("word")) for k in ROOT_LETTERS]
    roots = counted.select("language", "trusted", "toxic", F.explode(F.array_distinct(F.array("word", *begins))).alias("root")) \
        .groupBy("language", "root").agg(F.sum("trusted").alias("trusted"), F.sum("toxic").alias("toxic")).filter("toxic > 0").join(totals, "language")
    ratio = F.log((F.col("toxic") + 0.5) / F.col("all_toxic")) - F.log((F.col("trusted") + 0.5) / F.col("all_trusted"))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("trusted") + 0.5))
    found: dict[str, dict[str, float]] = {}
    for r in roots.select("language", "root", ratio.alias("ratio"), error.alias("error")).filter(F.col("ratio") - ROOT_ERRORS * F.col("error") > math.log(ROOT_RATIO)).collect():
        found.setdefault(r["language"], {})[r["root"]] = r["ratio"]
    return found


def _counted(texts: DataFrame) -> DataFrame:
    """``(model, code, c)``: how often each gram occurs in the ``texts (model, text)``."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def add(model, codes, counts):
            before = held.get(model)
            if before:
                codes, counts = np.concatenate([before[0], codes]), np.concatenate([before[1], counts])
                codes, where = np.unique(codes, return_inverse=True)
                counts = np.bincount(where, weights=counts).astype(np.int64)
            held[model] = [codes, counts]

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                models = np.array(part.column(0).to_pylist())
                own = [grams(t or "") for t in part.column(1).to_pylist()]
                for model in set(models.tolist()):
                    add(model, *np.unique(np.concatenate([g for g, x in zip(own, models) if x == model]), return_counts=True))
        for model, (codes, counts) in held.items():
            m = len(codes)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, model, np.int64)), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                                             ["model", "code", "c"])

    parts = texts.mapInArrow(run, "model long, code long, c long")
    return parts.groupBy("model", "code").agg(F.sum("c").alias("c"))


def _discounts(tables: dict[int, DataFrame]) -> dict[tuple[int, int], list[float]]:
    """(order, model) -> the three discounts of modified Kneser-Ney, from the counts of counts."""
    found: dict[tuple[int, int], list[float]] = {}
    seen = None
    for order, t in tables.items():
        part = t.filter("c <= 4").groupBy("model", "c").agg(F.count(F.lit(1)).alias("n")).withColumn("order", F.lit(order))
        seen = part if seen is None else seen.unionByName(part)
    n = {(r["order"], r["model"], r["c"]): r["n"] for r in seen.collect()}  # at most ORDER * 2 * 4 rows
    for order in tables:
        for model in range(len(MODELS)):
            n1, n2, n3, n4 = (n.get((order, model, c), 0) for c in (1, 2, 3, 4))
            y = n1 / max(1, n1 + 2 * n2)
            raw = [c - (c + 1) * y * b / max(1, a) for c, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            found[order, model] = [min(max(d, 0.05), c - 0.05) for d, c in zip(raw, (1, 2, 3))]
    return found


def train(texts: DataFrame) -> DataFrame:
    """``(model, order, code, p, gamma)``: the probability of every seen gram of every order, and what its
    context leaves to the shorter one. ``texts (model, text)`` may be empty."""
    tables = {ORDER: written(_counted(texts), "grams")}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = written(tables[order + 1].groupBy("model", (F.col("code") % SYMBOLS ** order).alias("code"))
                                .agg(F.count(F.lit(1)).alias("c")), "grams")
    discounts = _discounts(tables)
    out = lower = None
    for order in range(1, ORDER + 1):
        taken = F.lit(0.0)
        for model in range(len(MODELS)):
            d = discounts[order, model]
            taken = F.when(F.col("model") == model, F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).otherwise(taken)
        counts = tables[order].select("model", "code", (F.col("code") / SYMBOLS).cast("long").alias("context"), "c", taken.alias("taken"))
        contexts = counts.groupBy("model", "context").agg(F.sum("c").alias("total"), (F.sum("taken") / F.sum("c")).alias("gamma"))
        seen = counts.join(contexts, ["model", "context"]).withColumn("own", (F.col("c") - F.col("taken")) / F.col("total"))
        if lower is None:
            seen = seen.withColumn("p", F.col("own") + F.col("gamma") / SYMBOLS)
        else:
            shorter = lower.select("model", F.col("code").alias("suffix"), F.col("p").alias("short"))
            seen = seen.withColumn("suffix", F.col("code") % SYMBOLS ** (order - 1)).join(shorter, ["model", "suffix"]) \
                .withColumn("p", F.col("own") + F.col("gamma") * F.col("short"))
        lower = written(seen.select("model", F.lit(order).alias("order"), "code", "p", "gamma"), "kn")
        out = lower if out is None else out.unionByName(lower)
    return out


def compact(model: DataFrame) -> tuple[np.ndarray, ...]:
    """The model's rows as arrays of 14 bytes a row; no more rows than there are grams."""
    table = model.toArrow()
    kinds = (np.int8, np.int8, np.int32, np.float32, np.float32)
    return tuple(table.column(i).to_numpy().astype(k) for i, k in enumerate(kinds))


def dense(rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(log probability under the trusted model, log ratio toxic to trusted) of every gram, in half
    precision: 2 * SYMBOLS ** ORDER * 2 bytes (82 MB), however large the corpus."""
    which, order, code, p, gamma = rows
    logs = []
    for m in range(len(MODELS)):
        full = np.full(1, 1 / SYMBOLS, np.float32)
        for k in range(1, ORDER + 1):
            mine = (which == m) & (order == k)
            left = np.ones(SYMBOLS ** (k - 1), np.float32)
            left[code[mine] // SYMBOLS] = gamma[mine]
            longer = np.empty(SYMBOLS ** k, np.float32)
            if k == 1:
                longer[:] = left[0] / SYMBOLS
            else:
                rows = longer.reshape(SYMBOLS, -1)
                for first, share in enumerate(left.reshape(SYMBOLS, -1)):
                    np.multiply(full, np.repeat(share, SYMBOLS), out=rows[first])
            longer[code[mine]] = p[mine]
            full = longer
        np.log(full, out=full)
        logs.append(full.astype(np.float16))
        any_seen = bool((which == m).any())
        if m and not any_seen:
            return logs[0], np.zeros_like(logs[0])
    np.subtract(logs[1], logs[0], out=logs[1])
    return logs[0], logs[1]


_LAID_OUT: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _laid_out(name: str, rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``dense(rows)``, once per worker and model."""
    if name not in _LAID_OUT:
        _LAID_OUT.clear()
        _LAID_OUT[name] = dense(rows)
    return _LAID_OUT[name]


def score(docs: DataFrame, model: DataFrame, steps: np.ndarray, roots: dict[str, dict[str, float]]) -> DataFrame:
    """``(doc_id, k1, k2, lang, chars, loss, toxic_word, n_words, jolt, rooted)``: the summed surprise of the text's
    characters under the trusted model, the largest log ratio of a word (long words count in proportion),
    the number of words, the summed ``steps`` of their rhythm, and their summed ratios by ``roots``."""
    spark = docs.sparkSession
    name = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((compact(model), steps, roots))

    def run(batches):
        rows, steps, found = shared.value
        log_p, ratio = _laid_out(name, rows)
        numbers: dict[str, Numbers] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                chars, loss, worst, n_words, jolt, rooted = [], [], [], [], [], []
                for lang, text in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
                    language = (lang or "") if (lang or "") in found else None  # languages without roots share one
                    own = numbers.setdefault(language, Numbers(found.get(language, {})))
                    seq = own.of(text or "")
                    n_words.append(len(seq))
                    jolt.append(float(steps[rhythm(seq)].sum()))
                    rooted.append(float(sum(map(own.ratios.__getitem__, seq.tolist()))) if language is not None else 0.0)
                    g = grams(text or "")
                    chars.append(len(g))
                    loss.append(-float(log_p[g].sum(dtype=np.float64)))
                    if not len(g):
                        worst.append(0.0)
                        continue
                    word = np.cumsum(g % SYMBOLS == SPACE)
                    sums, sizes = np.bincount(word, weights=ratio[g]), np.bincount(word)
                    worst.append(float((sums * np.minimum(1.0, LONG_WORD / np.maximum(sizes, 1))).max()))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(np.array(chars, np.int64)), pa.array(np.array(loss, np.float64)), pa.array(np.array(worst, np.float64)),
                                                  pa.array(np.array(n_words, np.int64)), pa.array(np.array(jolt, np.float64)), pa.array(np.array(rooted, np.float64))],
                                                 ["doc_id", "k1", "k2", "lang", "chars", "loss", "toxic_word", "n_words", "jolt", "rooted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = written(docs.select("doc_id", *row_key(), "lang", "text").mapInArrow(
        run, f"doc_id {kind}, k1 long, k2 long, lang string, chars long, loss double, toxic_word double, n_words long, jolt double, rooted double"), "scores")
    shared.destroy()
    return scored


def label_kinds(labels: DataFrame) -> DataFrame:
    """``(doc_id, model)`` of labelled documents: 0 trusted, 1 toxic, null neither. Of several labels the worse counts."""
    worst = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return worst.select("doc_id", F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 0).cast("long").alias("model")).filter("model is not null")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, perplexity, toxic_word, keep`` and the row key, for every document.

    Documents without text (null or empty) are not judged: perplexity 1, kept. Without any
    trusted document all are kept; without toxic ones only perplexity rejects. A null language
    is one of its own. Repeated rows are judged alike; other columns are ignored.
    """
    kinds = written(label_kinds(labels), "kinds")
    near = F.broadcast(kinds) if kinds.count() <= BROADCAST_LABELS else kinds.hint("merge")
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("language"), "text").join(near, "doc_id").select("language", "model", "text")
    model = train(texts.select("model", "text"))
    scored = score(docs, model, step_costs(texts.filter("model = 0")), toxic_roots(texts))
    scored = scored.withColumn("root", F.col("rooted") / (F.col("n_words") + ROOT_WORDS))
    trusted = scored.join(kinds.filter("model = 0"), "doc_id", "left_semi").filter("chars > 0") \
        .select(F.coalesce("lang", F.lit("")).alias("language"), (F.col("loss") / F.col("chars")).alias("rate"), "toxic_word",
                (F.col("jolt") / F.greatest("n_words", F.lit(1))).alias("beat"), "root")

    def limits(rows: DataFrame, by: list[str], prefix: str) -> DataFrame:
        exact = 10_000
        factors = {"rate": PERPLEXITY_FACTOR, "toxic_word": TOXIC_FACTOR, "beat": RHYTHM_FACTOR, "root": ROOT_FACTOR}
        q = rows.groupBy(*by).agg(*[F.percentile_approx(x, [0.5, 0.99], exact).alias(x) for x in factors], F.count(F.lit(1)).alias("n"))
        return q.select(*by, F.col("rate")[0].alias(f"{prefix}median"), F.col("beat")[0].alias(f"{prefix}beat_median"), F.col("n").alias(f"{prefix}n"),
                        *[(F.col(x)[1] + f * (F.col(x)[1] - F.col(x)[0])).alias(f"{prefix}{x}") for x, f in factors.items()])

    own = written(limits(trusted, ["language"], "own_").filter(F.col("own_n") >= LEAST_TRUSTED), "limits")
    of_all = limits(trusted, [], "all_").first()  # one row
    pick = lambda name: F.coalesce(F.col(f"own_{name}"), F.lit(of_all[f"all_{name}"]).cast("double"))
    judged = scored.withColumn("language", F.coalesce("lang", F.lit(""))).join(own, "language", "left")
    rate = (F.col("loss") + PRIOR_CHARS * pick("median")) / (F.col("chars") + PRIOR_CHARS)
    beat = (F.col("jolt") + RHYTHM_WORDS * pick("beat_median")) / (F.col("n_words") + RHYTHM_WORDS)
    bad = (F.col("chars") > 0) & ((rate > pick("rate")) | (F.col("toxic_word") > pick("toxic_word")) | (beat > pick("beat")) | (F.col("root") > pick("root")))
    return judged.select("doc_id", "k1", "k2", "lang", F.exp(F.when(F.col("chars") > 0, F.col("loss") / F.col("chars")).otherwise(0.0)).alias("perplexity"),
                         "toxic_word", (~F.coalesce(bad, F.lit(False))).alias("keep"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query ``op7_kneser_ney``."""
    return judge(docs, labels).select("doc_id", "lang", "perplexity", "toxic_word", "keep")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    bad = judge(docs, labels).filter(~F.col("keep")).select("k1", "k2").distinct()
    # merge: one plan at every size; the rejected rows grow with the corpus
    return keyed(docs).join(bad.hint("merge"), ["k1", "k2"], "left_anti").select("row.*")
