"""JN-1, WN-1, AG-1: price joins by validity interval and as of a time, latest dimension row, cost per resource.

Prices keep history: one row per (sku, validity interval). Usage is priced with an
equi join on the SKU plus a half-open interval residual ``start <= d < end`` (a NULL
end means "still valid"). The equi key lets Spark use a hash or sort-merge join with
the interval as a residual filter, so no range-join machinery or cross product is
needed. A SKU that carries an outsized share of usage is split by AQE as long as the
join's output does not feed an operator that needs the same partitioning; other columns
of the price list (``keep``) come with the same join, so usage is not joined by SKU twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from meterlake.functions.columns import MONEY, ntz_lit
from meterlake.session import stored


def price_versions(dim: DataFrame, sku: str, base_price: str,
                   versions: list[tuple[str, str | None, str]], keep: dict[str, str] | None = None) -> DataFrame:
    """Expand a price list into validity versions ``(start, end, factor)``.

    Output: ``sku, price_start_time, price_end_time, price`` and the columns ``keep`` with
    ``price = round(base * factor, 2)`` in decimal. Uses ``explode`` (a generator,
    no join), so it is one narrow pass over ``dim``.
    """
    arr = F.array(*[
        F.struct(ntz_lit(s).alias("s"),
                 (ntz_lit(e) if e else F.lit(None).cast("timestamp_ntz")).alias("e"),
                 F.lit(f).cast("decimal(3,2)").alias("f"))
        for s, e, f in versions
    ])
    keep = keep or {}  # output name -> column of ``dim``
    return (dim.select(F.col(sku).alias("sku"), F.col(base_price).alias("__base"),
                       *[F.col(c).alias(name) for name, c in keep.items()], F.explode(arr).alias("__v"))
            .select("sku", *keep,
                    F.col("__v.s").alias("price_start_time"),
                    F.col("__v.e").alias("price_end_time"),
                    F.round(F.col("__base").cast(MONEY) * F.col("__v.f"), 2).cast(MONEY).alias("price")))


def _valid(d: Column, start: Column, end: Column) -> Column:
    d = d.cast("timestamp_ntz")
    return (d >= start) & (end.isNull() | (d < end))


def price_usage(usage: DataFrame, prices: DataFrame, sku: str = "sku", date: str = "usage_date",
                qty: str = "quantity", keep: tuple[str, ...] = ()) -> DataFrame:
    """JN-1: attach the price valid on ``date`` and ``cost = qty * price``.

    Decimal and whole quantities are priced exactly, in their own precision; floating ones
    stay floating. ``keep`` names further columns of ``prices`` to attach.

    Half-open intervals (D-11): touching versions never both match, and an open end
    keeps the current price. Rows without a valid price are dropped here; see
    :func:`unpriced` for the report of those rows.
    """
    p = prices.select(F.col("sku").alias("__sku"), F.col("price_start_time").alias("__ps"),
                      F.col("price_end_time").alias("__pe"), "price", *keep)
    j = usage.join(p, (F.col(sku) == F.col("__sku")) & _valid(F.col(date), F.col("__ps"), F.col("__pe")))
    return (j.drop("__sku", "__ps", "__pe")
            .withColumn("cost", F.col(qty) * F.col("price")))


#: Rows of one SKU, usage and versions, that one task walks through; more are cut into time bins, and the
#: usage rows of a bin that are still more are dealt over several.
ASOF_ROWS = 1_000_000


def price_usage_asof(usage: DataFrame, prices: DataFrame, sku: str = "sku", date: str = "usage_date", qty: str = "quantity",
                     keep: tuple[str, ...] = (), bin_days: int = 32, rows_per_task: int = ASOF_ROWS) -> DataFrame:
    """JN-1 for price lists of many versions a SKU: ``price_usage`` in one sorted pass.

    An interval join pairs every usage row with all versions of its SKU before it drops all but
    one. Here usage and version starts are united, sorted by time within a SKU, and the newest version
    so far is carried forward to the usage rows: rows read grow with usage plus versions, not with their
    product, and each is shuffled once. A hot SKU, one of more than ``rows_per_task`` rows, is cut into bins
    of ``bin_days``; the version that is open when a bin begins comes from the same carry over the (far
    fewer) bins that hold usage. A bin with more than ``rows_per_task`` usage rows is dealt over several tasks,
    each with the bin's few versions. The hot SKUs and bins are one in ``rows_per_task`` rows at most; they are written once.

    A usage row takes the version that started last (of versions that start together, the one that ends
    last, an open one most of all; see ``price_overlaps``), if that has not ended; rows before the first version, in a gap,
    or without SKU or date are dropped, as ``price_usage`` does.
    """
    time = lambda c: F.col(c).cast("timestamp_ntz")
    bin_of = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bin_days)
    forever = F.lit("9999-12-31").cast("timestamp_ntz")
    version = F.struct(F.coalesce("price_end_time", forever).alias("end"), "price", *keep)
    starts = prices.filter("sku IS NOT NULL AND price_start_time IS NOT NULL").select(
        F.col("sku").alias("__sku"), time("price_start_time").alias("__t"), version.alias("__v"))
    used = usage.filter(F.col(sku).isNotNull() & F.col(date).isNotNull())
    used = used.select(F.col(sku).alias("__sku"), time(date).alias("__t"), F.struct(*[F.col(f"`{c}`") for c in usage.columns]).alias("__u"))
    none_v, none_u = F.lit(None).cast(starts.schema["__v"].dataType), F.lit(None).cast(used.schema["__u"].dataType)
    rows = starts.select("__sku", "__t", F.lit(1).alias("__kind"), "__v", none_u.alias("__u")) \
        .unionByName(used.select("__sku", "__t", F.lit(2).alias("__kind"), none_v.alias("__v"), "__u"))

    one = F.count(F.lit(1)).alias("__n")
    # written, so that their size is known and the joins with them move no other rows
    hot = stored(rows.groupBy("__sku").agg(one).filter(F.col("__n") > rows_per_task).select("__sku", F.lit(True).alias("__hot")), "hot")
    # a SKU that is not hot has no bins, and its bin is NULL
    rows = rows.join(hot, "__sku", "left").withColumn("__bin", F.when(F.col("__hot"), bin_of(F.col("__t")))).drop("__hot")

    binned = rows.filter("__bin IS NOT NULL")
    bins = binned.filter("__kind = 2").groupBy("__sku", "__bin").agg(one)
    before = Window.partitionBy("__sku").orderBy("__bin", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = binned.filter("__kind = 1").groupBy("__sku", "__bin").agg(F.max_by("__v", F.struct("__t", "__v")).alias("__v"))
    # a bin opens with the newest version of the bins before it: its own versions (kind 1) come after its opening (kind 0)
    marks = bins.select("__sku", "__bin", F.lit(0).alias("__kind"), "__n", none_v.alias("__v")) \
        .unionByName(newest.select("__sku", "__bin", F.lit(1).alias("__kind"), F.lit(0).cast("long").alias("__n"), "__v"))
    opening = marks.withColumn("__v", F.last("__v", ignorenulls=True).over(before)).filter("__kind = 0")

    parts = F.ceil(F.col("__n") / rows_per_task).cast("int")
    dense = stored(bins.filter(F.col("__n") > rows_per_task).select("__sku", "__bin", parts.alias("__parts")), "dense")
    opened = opening.select("__sku", "__bin", F.explode(F.sequence(F.lit(0), parts - 1)).alias("__part"),
                            F.lit(None).cast("timestamp_ntz").alias("__t"), F.lit(0).alias("__kind"), "__v", none_u.alias("__u"))
    # the usage rows of a dense bin go to one of its parts each, its versions to all
    several = F.coalesce("__parts", F.lit(1))
    own = F.when(F.col("__kind") == 2, F.pmod(F.xxhash64(F.monotonically_increasing_id()), several).cast("int"))
    dealt = rows.join(dense, ["__sku", "__bin"], "left").withColumn("__own", own)
    dealt = dealt.withColumn("__part", F.explode(F.when(F.col("__own").isNull(), F.sequence(F.lit(0), several - 1)).otherwise(F.array("__own"))))

    place = ["__sku", "__bin", "__part"]
    both = opened.unionByName(dealt.drop("__parts", "__own"))
    # of versions that start together the last one in this order is the one to take
    so_far = Window.partitionBy(*place).orderBy("__t", "__kind", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    priced = both.withColumn("__v", F.last("__v", ignorenulls=True).over(so_far)).filter((F.col("__kind") == 2) & (F.col("__t") < F.col("__v.end")))
    return priced.select("__u.*", "__v.price", *[F.col(f"__v.{c}") for c in keep]).withColumn("cost", F.col(qty) * F.col("price"))


def unpriced(usage: DataFrame, prices: DataFrame, sku: str = "sku", date: str = "usage_date") -> DataFrame:
    """Usage rows with no valid price (left anti join on the same condition)."""
    p = prices.select(F.col("sku").alias("__sku"), F.col("price_start_time").alias("__ps"),
                      F.col("price_end_time").alias("__pe"))
    return usage.join(p, (F.col(sku) == F.col("__sku")) & _valid(F.col(date), F.col("__ps"), F.col("__pe")),
                      "left_anti")


def price_overlaps(prices: DataFrame) -> DataFrame:
    """Versions whose interval overlaps the next one of the same SKU (a usage row would price twice).

    ``lag``-style check over versions ordered by start; each window partition is the
    version history of one SKU, which is small.
    """
    w = Window.partitionBy("sku").orderBy("price_start_time")
    nxt = F.lead("price_start_time").over(w)
    return (prices.withColumn("next_start", nxt)
            .filter(F.col("next_start").isNotNull()
                    & (F.col("price_end_time").isNull() | (F.col("next_start") < F.col("price_end_time")))))


def latest(dim: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """WN-1: the newest row per key of a history dimension.

    Written as ``max_by`` per key instead of a ``row_number`` window: it is an ordinary
    aggregate with map-side partial aggregation, so a key with a very long history is
    reduced before the shuffle and never has to sit in one task. Ties on the order columns
    are broken by the remaining columns that can be ordered (all but maps).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in dim.columns if c not in keys]
    ordered = [c for c in rest if c not in order_cols and "map<" not in dim.schema[c].dataType.simpleString()]
    newest = F.max_by(F.struct(*rest), F.struct(*order_cols, *ordered)).alias("__m")
    return dim.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__m.{c}").alias(c) for c in rest])
