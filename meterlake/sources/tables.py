"""SRC-1: read a whole table by name.

A "catalog" in stock Spark is a folder of Parquet tables (or a ``dict`` of DataFrames);
reads stay lazy so Catalyst prunes columns and pushes filters into the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``<root>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def discover(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """SRC-1 over a folder: ``schema.table`` -> lazy DataFrame for every ``<root>/<schema>/<table>``
    (a ``.parquet`` ending is not part of the name); hidden names are left out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [(x.getPath().getParent().getName(), x.getPath().getName(), x.getPath().toString()) for x in found]
    return {f"{schema}.{table.removesuffix('.parquet')}": spark.read.parquet(full)
            for schema, table, full in names if schema[0] not in "._" and table[0] not in "._"}


class Tables:
    """Lazy accessor for the tables of one folder: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = load(self.spark, self.root, name)
        return self._frames[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    @cached_property
    def lineitem(self) -> DataFrame:
        return self["lineitem"]

    @cached_property
    def orders(self) -> DataFrame:
        return self["orders"]

    @cached_property
    def customer(self) -> DataFrame:
        return self["customer"]

    @cached_property
    def part(self) -> DataFrame:
        return self["part"]

    @cached_property
    def supplier(self) -> DataFrame:
        return self["supplier"]

    @cached_property
    def nation(self) -> DataFrame:
        return self["nation"]

    @cached_property
    def region(self) -> DataFrame:
        return self["region"]

    @cached_property
    def events(self) -> DataFrame:
        return self["events"]
