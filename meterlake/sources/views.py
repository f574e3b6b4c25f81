"""SNK-10: publish results as named, replaceable views.

A view is a lazy DataFrame: publishing registers the plan, and nothing is read until a
query uses it (filters and column pruning then reach the underlying scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def view_name(name: str) -> str:
    """``schema.table`` becomes a single-part temp view name ``schema__table``."""
    return name.replace(".", "__")


def publish(df: DataFrame, name: str) -> str:
    """``CREATE OR REPLACE TEMP VIEW``; returns the registered name."""
    n = view_name(name)
    df.createOrReplaceTempView(n)
    return n


def publish_all(views: dict[str, DataFrame]) -> list[str]:
    return [publish(df, name) for name, df in views.items()]
