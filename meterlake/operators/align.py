"""UN-1..6, PRJ-2..4: the same table from several catalogs as one schema-aligned UNION ALL.

Only schema metadata is inspected on the driver (``df.schema``); the union itself is a
lazy plan, so filters and column pruning still reach every branch's scan, and a
branch whose filtered column is a typed NULL is removed by the optimizer.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

REGIONAL, GLOBAL, MIXED = "REGIONAL", "GLOBAL", "MIXED"

# to_json options: keep microseconds (the default format cuts timestamps to
# milliseconds); NULL struct fields are dropped, which is Spark's default.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@dataclass(frozen=True)
class Alignment:
    """UN-2 result.

    columns     union column names, first-seen order over catalogs, first spelling wins
    mismatched  lower-cased names whose types differ among the catalogs that have them
    types       catalog -> lower-cased name -> type
    names       catalog -> lower-cased name -> spelling in that catalog
    present     catalogs (in the given order) that have the table
    """
    columns: list[str]
    mismatched: frozenset[str]
    types: dict[str, dict[str, DataType]] = field(default_factory=dict)
    names: dict[str, dict[str, str]] = field(default_factory=dict)
    present: list[str] = field(default_factory=list)


def analyze(frames: dict[str, DataFrame | None]) -> Alignment:
    """UN-2: union column list and type-mismatch set. ``None`` frames mean "table absent"."""
    present = [c for c, df in frames.items() if df is not None]
    types: dict[str, dict[str, DataType]] = {}
    names: dict[str, dict[str, str]] = {}
    columns: list[str] = []
    seen: set[str] = set()
    for cat in present:
        types[cat], names[cat] = {}, {}
        for f in frames[cat].schema.fields:
            low = f.name.lower()
            if low in types[cat]:
                raise ValueError(f"catalog {cat}: column {f.name!r} appears twice ignoring case")
            types[cat][low] = f.dataType
            names[cat][low] = f.name
            if low not in seen:
                seen.add(low)
                columns.append(f.name)
    mismatched = set()
    for col in columns:
        low = col.lower()
        kinds = {types[c][low].simpleString() for c in present if low in types[c]}
        if len(kinds) > 1:
            mismatched.add(low)
    return Alignment(columns, frozenset(mismatched), types, names, present)


def reconcile(c: Column, dtype: DataType) -> Column:
    """PRJ-3: text form of a type-mismatched column (JSON for complex types, cast for scalars)."""
    if isinstance(dtype, (StructType, ArrayType, MapType)):
        return F.to_json(c, JSON_OPTIONS)
    return c.cast("string")


def _target_type(al: Alignment, low: str) -> str:
    if low in al.mismatched:
        return "string"
    for cat in al.present:
        if low in al.types[cat]:
            return al.types[cat][low].simpleString()
    raise KeyError(low)


def aligned_select(df: DataFrame, cat: str, al: Alignment) -> DataFrame:
    """PRJ-2..4: one catalog's branch projected onto the union column list."""
    out = []
    for col in al.columns:
        low = col.lower()
        if low not in al.types[cat]:
            out.append(F.lit(None).cast(_target_type(al, low)).alias(col))
        elif low in al.mismatched:
            out.append(reconcile(F.col(f"`{al.names[cat][low]}`"), al.types[cat][low]).alias(col))
        else:
            out.append(F.col(f"`{al.names[cat][low]}`").alias(col))
    return df.select(*out)


def aligned_union(frames: dict[str, DataFrame | None], al: Alignment | None = None) -> DataFrame | None:
    """UN-1: UNION ALL (duplicates kept) of every catalog that has the table; None if none has it."""
    al = al or analyze(frames)
    if not al.present:
        return None
    parts = [aligned_select(frames[c], c, al) for c in al.present]
    return reduce(DataFrame.unionByName, parts)


def consolidate(frames: dict[str, DataFrame | None], regionality: str = REGIONAL,
                key: list[str] | None = None) -> DataFrame | None:
    """UN-3 / UN-4: apply the table's regionality.

    GLOBAL  identical in every account: the primary (first) catalog only, None if it lacks it.
    MIXED   account-level rows repeat in every catalog: a key's rows are taken from the first
            catalog that has it, all of them; rows whose key is not complete (any NULL)
            are kept. Without a key it behaves as REGIONAL.
    other   aligned UNION ALL.
    """
    if regionality == GLOBAL:
        primary = next(iter(frames))
        return frames[primary]
    if regionality != MIXED or not key:
        return aligned_union(frames)
    out = aligned_union({c: None if df is None else df.withColumn("__catalog", F.lit(i)) for i, (c, df) in enumerate(frames.items())})
    if out is None:
        return None
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    # the first catalog of each key: an aggregate of at most one row per key and catalog after its map side
    first = out.filter(keyed).groupBy(*key).agg(F.min("__catalog").alias("__first"))
    chosen = out.filter(keyed).join(first, list(key)).filter(F.col("__catalog") == F.col("__first")).drop("__first")
    return chosen.unionByName(out.filter(~keyed)).drop("__catalog").select(*[c for c in out.columns if c != "__catalog"])


def _excluded(name: str, excluded) -> bool:
    schema, _, table = name.partition(".")
    return schema in excluded or schema.startswith("__") or table.startswith("__")


def consolidate_all(catalogs: dict[str, dict[str, DataFrame]], rule, excluded=("information_schema", "metadata"),
                    discover: str = "primary") -> tuple[dict[str, DataFrame], dict[str, str], list[str]]:
    """UN-5: consolidate every ``schema.table`` of the catalogs.

    ``rule(name) -> (regionality, key | None)`` supplies the table's regionality.
    Tables are discovered in the primary catalog (``discover="primary"``, D-14) or in
    any catalog (``"all"``); excluded schemas and ``__``-prefixed schemas or tables
    are skipped (D-8). Returns the views, the regionality used per view, and the
    names that produced no view.
    """
    cats = list(catalogs)
    if discover == "primary":
        names = list(catalogs[cats[0]])
    else:
        names = []
        for c in cats:
            names += [n for n in catalogs[c] if n not in names]
    views, modes, skipped = {}, {}, []
    for name in names:
        if _excluded(name, excluded):
            continue
        regionality, key = rule(name)
        frames = {c: catalogs[c].get(name) for c in cats}
        v = consolidate(frames, regionality, key)
        if v is None:
            skipped.append(name)
            continue
        views[name], modes[name] = v, regionality
    return views, modes, skipped


def row_counts(views: dict[str, DataFrame], name_col: str = "view") -> DataFrame:
    """AG-17: ``view, rows`` for every view, as one union of global count aggregates."""
    parts = [v.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias(name_col), "rows")
             for n, v in views.items()]
    return reduce(DataFrame.unionByName, parts)


def drift_report(frames: dict[str, DataFrame | None], table: str) -> DataFrame:
    """UN-6: per column and catalog: its type and status (ok / missing / mismatch) and the
    catalog's row count (the rows the status affects).

    The schema part is driver metadata (columns x catalogs); the row counts are
    Spark aggregates, joined on the catalog name.
    """
    al = analyze(frames)
    spark = next(df for df in frames.values() if df is not None).sparkSession
    meta = []
    for col in al.columns:
        low = col.lower()
        for cat in frames:
            t = al.types.get(cat, {}).get(low)
            status = "missing" if t is None else ("mismatch" if low in al.mismatched else "ok")
            meta.append((table, col, cat, None if t is None else t.simpleString(), status))
    m = spark.createDataFrame(meta, "table string, column string, catalog string, type string, status string")
    counts = row_counts({c: frames[c] for c in al.present}, "catalog")
    return m.join(counts, "catalog", "left").select("table", "column", "catalog", "type", "status", "rows")
