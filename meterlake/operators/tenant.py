"""TEN-1..3, PRJ-1, AG-18: tenant scoping through a dimension predicate.

The fact keeps every column and only rows whose tenant key is in the filtered
dimension. Written as a LEFT SEMI join: a repeated dimension key never multiplies
fact rows, a NULL fact key never matches, and Spark chooses the physical join from
statistics (broadcast when the filtered key list is under the broadcast bound,
otherwise a shuffled semi join), so a large dimension does not break the plan.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _find(df: DataFrame, name: str) -> str | None:
    """Case-insensitive column lookup (D-19); returns the actual spelling."""
    low = name.lower()
    for c in df.columns:
        if c.lower() == low:
            return c
    return None


def tenant_scope(fact: DataFrame, dim: DataFrame, key: str, sql_filter: str,
                 dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose ``key`` is a ``dim_key`` of a ``dim`` row matching ``sql_filter``.

    ``sql_filter`` is one SQL boolean expression over the dimension (e.g.
    ``workspace_name RLIKE '.*dev.*'``). It is parsed as an expression, not spliced
    into a statement; it must still come from a trusted administrator.
    """
    fk = _find(fact, key)
    if fk is None:
        raise ValueError(f"fact has no column {key!r}")
    dk = _find(dim, dim_key or key)
    if dk is None:
        raise ValueError(f"dimension has no column {(dim_key or key)!r}")
    keys = dim.filter(F.expr(sql_filter)).select(F.col(dk).alias("__tenant_key"))
    return fact.join(keys, F.col(fk) == F.col("__tenant_key"), "left_semi")


def tenant_bits(dim: DataFrame, dim_key: str, sql_filters: dict[str, str]) -> DataFrame:
    """``__tenant_key, __bits``: for every dimension key that fits any filter, the tenants it fits as bits.

    Bit ``i % 63`` of word ``i // 63`` stands for the filter of position ``i``. A repeated key fits what any of its rows
    fits; a predicate that is NULL does not fit.
    """
    fits = [F.coalesce(F.expr(p).cast("boolean"), F.lit(False)) for p in sql_filters.values()]
    words = []
    for lo in range(0, len(fits), 63):
        word = F.lit(0).cast("long")
        for i, fit in enumerate(fits[lo:lo + 63]):
            word = word.bitwiseOR(F.when(fit, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        words.append(word.alias(f"__w{lo // 63}"))
    each = dim.select(F.col(dim_key).alias("__tenant_key"), *words).filter("__tenant_key IS NOT NULL")
    names = [f"__w{i}" for i in range(len(words))]
    both = each.groupBy("__tenant_key").agg(*[F.bit_or(w).alias(w) for w in names])
    return both.filter(" OR ".join(f"{w} <> 0" for w in names)).select("__tenant_key", F.array(*names).alias("__bits"))


def tenant_fanout(fact: DataFrame, dim: DataFrame, key: str, sql_filters: dict[str, str], dim_key: str | None = None,
                  out: str = "tenant") -> DataFrame:
    """TEN-3 for many tenants at once: the rows of ``tenant_scope`` for each of ``sql_filters`` (tenant -> predicate), with the tenant's name in ``out``.

    The predicates are evaluated once per dimension row and kept as bits, so the fact is read, and
    joined, once however many tenants there are; its rows are then handed to the tenants whose
    bits are set. The key meets one row at most, so nothing is multiplied but by the tenants that see it.
    """
    if not sql_filters:
        raise ValueError("no tenants")
    fk, dk = _find(fact, key), _find(dim, dim_key or key)
    if fk is None or dk is None:
        raise ValueError(f"no column {key!r} in the fact, or {(dim_key or key)!r} in the dimension")
    bits = tenant_bits(dim, dk, sql_filters)
    joined = fact.join(bits, F.col(fk) == F.col("__tenant_key"))
    seen = [F.when(F.getbit(F.col("__bits")[i // 63], F.lit(i % 63)) == 1, F.lit(name)) for i, name in enumerate(sql_filters)]
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], F.explode(F.array_compact(F.array(*seen))).alias(out))


def is_readable(df: DataFrame) -> bool:
    """AG-18 / LIM-1: whether the plan resolves and a first row can be read (one row of one file at most)."""
    try:
        return len(df.limit(1).select(F.lit(1)).collect()) >= 0
    except PySparkException:
        return False


def tenant_scope_all(facts: dict[str, DataFrame], dim: DataFrame, key: str, sql_filter: str,
                     dim_key: str | None = None, probe: bool = False
                     ) -> tuple[dict[str, DataFrame], list[str]]:
    """TEN-3: scope every fact that has ``key``; return the scoped views and the skipped names.

    With ``probe`` a fact that cannot be read is skipped too; the probe reads the fact itself, not its join.
    """
    views: dict[str, DataFrame] = {}
    skipped: list[str] = []
    for name, fact in facts.items():
        if _find(fact, key) is None:
            skipped.append(name)
            continue
        if probe and not is_readable(fact):
            skipped.append(name)
            continue
        views[name] = tenant_scope(fact, dim, key, sql_filter, dim_key)
    return views, skipped


def scope_report(views: dict[str, DataFrame], skipped: list[str]) -> DataFrame:
    """Per-table outcome of TEN-3: ``table_name, scoped, rows`` (skipped tables: ``scoped`` false, 0 rows).

    One global aggregate per view, combined with ``unionByName``; each count is a
    partial + final aggregate, so no view is pulled through one task.
    """
    parts = [v.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table_name"), F.lit(True).alias("scoped"), "rows")
             for n, v in views.items()]
    if not parts:
        raise ValueError("no table has the tenant key")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    spark = out.sparkSession
    if skipped:
        sk = spark.createDataFrame([(n,) for n in skipped], "table_name string").select(
            "table_name", F.lit(False).alias("scoped"), F.lit(0).cast("bigint").alias("rows"))
        out = out.unionByName(sk)
    return out
