"""How the schema of a sync target may grow from batch to batch.

A batch may bring new columns, leave columns out and carry narrower or wider types of the same kind;
anything else is a conflict, found before a row is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType,
                               ShortType, StructField, StructType)

_WHOLE = [ByteType, ShortType, IntegerType, LongType]


class SchemaConflict(Exception):
    """A batch whose column has a type that the target's column cannot be widened to."""


def _same_kind(a: DataType, b: DataType, order: list) -> DataType | None:
    return max(a, b, key=lambda t: order.index(type(t))) if type(a) in order and type(b) in order else None


def widened(a: DataType, b: DataType, at: str = "") -> DataType:
    """The type that holds both, and that Parquet files of either are read as without loss.

    Whole numbers and floating ones widen to the longer type, whole ones of up to 32 bits also to double, decimals
    to enough digits on either side of the point; structs grow by fields, arrays and maps by their parts.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    found = _same_kind(a, b, _WHOLE) or _same_kind(a, b, [FloatType, DoubleType]) or _same_kind(a, b, [*_WHOLE[:3], DoubleType])
    if found is not None:
        return found
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return DecimalType(digits, scale)
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b, at)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType, f"{at}[]"), True)
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, widened(a.valueType, b.valueType, f"{at}{{}}"), True)
    raise SchemaConflict(f"{at}: {a.simpleString()} against {b.simpleString()}")


def merged(target: StructType, batch: StructType, at: str = "") -> StructType:
    """The target's columns in their order and spelling, widened by the batch's, then the batch's new ones."""
    new = {f.name.lower(): f for f in batch}
    out = []
    for f in target:
        g = new.pop(f.name.lower(), None)
        out.append(StructField(f.name, f.dataType if g is None else widened(f.dataType, g.dataType, f"{at}.{f.name}".lstrip(".")), True))
    return StructType(out + [StructField(g.name, g.dataType, True) for g in new.values()])


def fitted(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` with the target's spelling and types for the columns that it has."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{own[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in target if f.name.lower() in own])
