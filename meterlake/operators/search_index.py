"""FIL-5 over very many resources: substring search by a table of character grams.

``build`` writes, for every resource, the distinct runs of one, two and three characters of its lower-cased
name (the postings), sorted by gram, and how many resources have each gram. ``search`` looks up the
needle's grams: a name that contains the needle has them all, so the resources on all their lists are the
only candidates, and the names of these few are compared with the needle itself. Any of the
needle's grams would do, so the rarest are taken, and a gram that most names share (``_00``) is not read unless there is no
other. Needles of one and two characters are grams themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONGEST = 3
#: Grams of a needle whose lists are intersected: the rarest ones.
RAREST = 3


def _grams(name, length: int):
    """Runs of ``length`` characters of a name; a shorter name is its own, and only, run."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(name) - length + 1)), lambda i: F.substring(name, i, length))


def build(resources: DataFrame, keys: list[str], path: str, name: str = "name") -> None:
    """Write the index of ``resources``: its rows (``resources``), ``postings (gram, keys...)`` and ``counts (gram, n)``.

    Rows with a NULL or empty name have no postings; no search but that for the empty text finds them.
    """
    resources.write.mode("error").parquet(f"{path}/resources")
    rows = resources.sparkSession.read.schema(resources.schema).parquet(f"{path}/resources")
    low = F.lower(F.col(name))
    every = F.array_distinct(F.concat(*[_grams(low, n) for n in range(1, LONGEST + 1)]))
    found = rows.filter(F.length(name) > 0).select(*keys, F.explode(every).alias("gram"))
    found.repartitionByRange("gram", *keys).sortWithinPartitions("gram").write.mode("error").parquet(f"{path}/postings")
    counts = resources.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.sort("gram").write.mode("error").parquet(f"{path}/counts")


def needle_grams(needle: str) -> list[str]:
    """Grams that every name with the (lower-cased) needle has: the needle itself, or its runs of three characters."""
    if len(needle) <= LONGEST:
        return [needle] if needle else []
    return sorted({needle[i:i + LONGEST] for i in range(len(needle) - LONGEST + 1)})


def search(spark: SparkSession, path: str, needle: str, keys: list[str], name: str = "name") -> DataFrame:
    """The indexed resources whose name contains ``needle``, whatever the case: the rows of a ``contains`` scan."""
    rows, needle = spark.read.parquet(f"{path}/resources"), needle.lower()
    grams = needle_grams(needle)
    if not grams:
        return rows.filter(F.col(name).isNotNull())
    known = spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin(grams)).orderBy("n", "gram").limit(RAREST + len(grams)).collect()
    if len(known) < len(grams):  # no name has one of the grams
        return rows.limit(0)
    rare = [r["gram"] for r in known[:RAREST]]
    lists = [spark.read.parquet(f"{path}/postings").filter(F.col("gram") == g).select(*keys) for g in rare]
    on_all = reduce(lambda a, b: a.join(b, [a[k].eqNullSafe(b[k]) for k in keys], "left_semi"), lists)
    same = on_all.select(*[F.col(k).alias(f"__{k}") for k in keys])
    found = rows.join(same, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_semi")
    return found if len(needle) <= LONGEST else found.filter(F.lower(F.col(name)).contains(needle))
