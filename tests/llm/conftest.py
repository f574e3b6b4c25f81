import random

import pytest

#: Names that the operators use for columns of their own.
CLASHING = ["k1", "k2", "row", "n", "node", "hit", "cut", "spans", "shard", "slot", "comp", "w", "g", "c", "key", "model"]


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and long texts, ties, repeated rows and copies."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = text(200), text(60)
    near = base.split()
    near[50], near[120] = "changed", "words"
    rows = [(1, base, "en"), (2, base, "en"), (3, base.upper().replace(" ", ", "), "en"), (4, " ".join(near), "en"),
            (5, None, "en"), (6, "", "de"), (7, "  \n\t ", None), (8, "one", "fr"), (9, "one", "fr"),
            (10, text(20) + ". " + passage + " " + text(30), "en"), (11, text(40) + "\n" + passage + "\n\n" + text(10), "en"),
            (12, text(5000), "es"), (13, "x" * 30000, "en"), (14, passage, "de"), (None, text(30), "en"), (15, text(300), None),
            (16, "日本語 テキスト " * 40, "ja"), (1, base, "en"), (5, None, "en"), (17, " lead  double \n end ", "en")]
    return [(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return with_clashes(spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars int"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int"))
