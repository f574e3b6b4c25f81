"""DQ-1..4, JN-7: declared-key checks (uniqueness, nulls, referential integrity).

The registry declares keys but nothing enforces them; these checks are ordinary
aggregates and anti joins, so they scale like any other report. Key columns may be
dotted paths into structs (D-18).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _name(c: str) -> str:
    return c.replace(".", "_")


def pk_duplicates(df: DataFrame, pk) -> DataFrame:
    """DQ-1: key values occurring more than once, with their count ``n``."""
    pk = _cols(pk)
    return (df.groupBy(*[F.col(c).alias(_name(c)) for c in pk]).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def _any_null(pk: list[str]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])


def pk_nulls(df: DataFrame, pk) -> DataFrame:
    """DQ-2: one row ``rows, nulls``: rows with any key column NULL."""
    pk = _cols(pk)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(_any_null(pk)).cast("bigint").alias("nulls"))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """DQ-3 / JN-7: foreign-key values with no parent row, and how many child rows carry each.

    A NULL foreign key is not an orphan. The child side is counted per value (map-side
    first, so a busy value is one row before the shuffle) and the parent side reduced to
    its distinct keys; only those meet in the anti join.
    """
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    counts = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(_name(fk))).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(keys, F.col(_name(fk)) == F.col("__pk"), "left_anti")


@dataclass(frozen=True)
class KeyDecl:
    """Declared keys of one table: primary key columns and ``(column, parent table, parent column)``."""
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)


def key_report(frames: dict[str, DataFrame], decls: dict[str, KeyDecl]) -> DataFrame:
    """DQ-4: ``table_name, key_name, kind, rows, duplicates, nulls, orphans`` for every declared key.

    ``duplicates`` counts key values that occur more than once (primary keys);
    ``orphans`` counts child rows whose non-NULL value has no parent (foreign keys).
    A check that does not apply to a line (``kind`` tells which) reports 0.
    Each table is scanned once: its foreign keys are looked up with left joins against
    the parents' distinct keys, the rows are grouped by the primary key, and one global
    aggregate yields every line of that table (unpivoted with ``inline``).
    """
    parts = [_table_lines(frames[table], table, decl, frames) for table, decl in decls.items()
             if decl.primary_key or decl.foreign_keys]
    return reduce(DataFrame.unionByName, parts)


def _table_lines(df: DataFrame, table: str, decl: KeyDecl, frames: dict[str, DataFrame]) -> DataFrame:
    # Built from SQL expression text: one expression per step keeps the driver-side
    # construction cheap for reports over many tables.
    pk = list(decl.primary_key)
    fks = list(decl.foreign_keys)
    pcols = [f"__p{i}" for i in range(len(pk))]
    cur = df.selectExpr(*[f"{_sql_path(c)} AS __p{i}" for i, c in enumerate(pk)],
                        *[f"{_sql_path(fk)} AS __f{j}" for j, (fk, _, _) in enumerate(fks)])
    for j, (_, ptable, pcol) in enumerate(fks):
        keys = frames[ptable].selectExpr(f"{_sql_path(pcol)} AS __k{j}").distinct()
        cur = cur.join(keys, F.expr(f"__f{j} = __k{j}"), "left")
    flags = []
    for j in range(len(fks)):
        flags += [f"CAST(__f{j} IS NULL AS BIGINT) AS __fn{j}",
                  f"CAST(__f{j} IS NOT NULL AND __k{j} IS NULL AS BIGINT) AS __fo{j}"]
    cur = cur.selectExpr(*pcols, *flags)
    fsum = [f"sum(__fn{j}) AS __fn{j}" for j in range(len(fks))] + [f"sum(__fo{j}) AS __fo{j}" for j in range(len(fks))]
    if pk:
        anynull = " OR ".join(f"{c} IS NULL" for c in pcols)
        g = cur.groupBy(*pcols).agg(F.expr("count(1)").alias("__n"), *[F.expr(x) for x in fsum])
        tot = g.selectExpr("sum(__n) AS rows", f"count_if(__n > 1 AND NOT ({anynull})) AS dups",
                           f"coalesce(sum(CASE WHEN {anynull} THEN __n END), 0) AS pnulls",
                           *[f"sum({c}) AS {c}" for c in [f"__fn{j}" for j in range(len(fks))]
                             + [f"__fo{j}" for j in range(len(fks))]])
    else:
        tot = cur.selectExpr("count(1) AS rows", *fsum)

    def line(name, kind, dups, nulls, orph):
        return (f"named_struct('key_name', '{name}', 'kind', '{kind}', 'rows', CAST(rows AS BIGINT), "
                f"'duplicates', CAST({dups} AS BIGINT), 'nulls', CAST({nulls} AS BIGINT), "
                f"'orphans', CAST({orph} AS BIGINT))")
    lines = []
    if pk:
        lines.append(line(f"pk({', '.join(pk)})", "pk", "dups", "pnulls", "0"))
    for j, (fk, ptable, pcol) in enumerate(fks):
        lines.append(line(f"fk({fk} -> {ptable}.{pcol})", "fk", "0", f"coalesce(__fn{j}, 0)",
                          f"coalesce(__fo{j}, 0)"))
    return tot.selectExpr(f"inline(array({', '.join(lines)}))").selectExpr(
        f"'{table}' AS table_name", "key_name", "kind", "rows", "duplicates", "nulls", "orphans")


def _sql_path(c: str) -> str:
    """A column or dotted struct path as SQL text with each part quoted."""
    return ".".join(f"`{p}`" for p in c.split("."))
