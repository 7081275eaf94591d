"""Tables on shared storage: Parquet in directories of id ranges, plus a small description beside them.

    <root>/<table>/v=<version>/id_bucket=<n>/*.parquet     the rows
    <root>/<table>/_about/*.json                           one line per change of schema or version
    <root>/<table>/_merged-*/                              ranges on their way into place, left by a lost driver only

Ids grow with time and recent records change most, so a range of ids keeps a batch of changes in few directories,
where a hash would spread every batch over all of them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.session import hadoop_path, local_frame, path_exists
from ledgermill.specs import TableSpec

ABOUT_SCHEMA = "change int, version int, columns string, bucket_width bigint, slice_width bigint"


def range_of(key: str, width: int) -> Column:
    """The number of the id range a key falls in, exact for any BIGINT."""
    k = F.col(key)
    return F.call_function("div", k - F.pmod(k, F.lit(width).cast("bigint")), F.lit(width).cast("bigint"))


@dataclass(frozen=True)
class TableInfo:
    change: int
    version: int
    schema: T.StructType
    bucket_width: int
    slice_width: int


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def info(self, name: str) -> TableInfo | None:
        """The current description of a table; None where the table was never written."""
        about = f"{self.root}/{name}/_about"
        if not path_exists(self.spark, about):
            return None
        row = self.spark.read.schema(ABOUT_SCHEMA).json(about).orderBy(F.desc("change")).first()
        if row is None:
            return None
        return TableInfo(row.change, row.version, T.StructType.fromJson(json.loads(row.columns)), row.bucket_width,
                         row.slice_width)

    def describe(self, name: str, info: TableInfo) -> None:
        line = [(info.change, info.version, info.schema.json(), info.bucket_width, info.slice_width)]
        local_frame(self.spark, line, ABOUT_SCHEMA).coalesce(1).write.mode("append").json(
            f"{self.root}/{name}/_about"
        )

    def exists(self, name: str) -> bool:
        return self.info(name) is not None

    def data_path(self, name: str, info: TableInfo) -> str:
        return f"{self.root}/{name}/v={info.version}"

    def read_buckets(self, name: str, info: TableInfo) -> DataFrame:
        """All rows with their ``id_bucket``. The schema comes from the description: no footers are read for it,
        and files older than a column give NULL for it."""
        schema = T.StructType(info.schema.fields + [T.StructField("id_bucket", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.data_path(name, info))

    def empty(self, info: TableInfo) -> DataFrame:
        """No rows, in the columns and types of ``read_buckets``."""
        return local_frame(self.spark, [], T.StructType(info.schema.fields + [T.StructField("id_bucket", T.LongType())]))

    def read(self, spec: TableSpec | str) -> DataFrame:
        """The table, with every column its spec declares; where it was never written, no rows of them."""
        name = spec if isinstance(spec, str) else spec.name
        info = self.info(name)
        if info is not None and path_exists(self.spark, self.data_path(name, info)):
            if not isinstance(spec, str):
                info = replace(info, schema=widened(info.schema, spec.schema()))
            return self.read_buckets(name, info).drop("id_bucket", "_dates")
        if isinstance(spec, str):
            raise ValueError(f"table {name} does not exist")
        return local_frame(self.spark, [], spec.schema())

    def tail(self, spec: TableSpec | str, rows: int) -> DataFrame:
        """The last ranges of ids that hold ``rows`` rows between them, for readers of the newest records.

        The last range is counted, then the last eight together and so on; as a rule the first is enough, and the others are
        never read.
        """
        name = spec if isinstance(spec, str) else spec.name
        info = self.info(name)
        if info is None or not path_exists(self.spark, self.data_path(name, info)):
            return self.read(spec)
        fs, path = hadoop_path(self.spark, self.data_path(name, info))
        found = [s.getPath().getName() for s in fs.listStatus(path)]
        ranges = sorted((int(n.split("=")[1]) for n in found if n.startswith("id_bucket=")), reverse=True)
        table, edge, step = self.read_buckets(name, info), None, 1
        while ranges and edge is None:
            counts = table.where(F.col("id_bucket") >= ranges[:step][-1]).groupBy("id_bucket").count().collect()
            held = {r["id_bucket"]: r["count"] for r in counts}
            reached = accumulate(held.get(k, 0) for k in ranges[:step])
            edge = next((k for k, n in zip(ranges, reached) if n >= rows), ranges[-1] if step >= len(ranges) else None)
            step *= 8
        return table.where(F.col("id_bucket") >= F.lit(edge)).drop("id_bucket", "_dates")

    def drop_old_versions(self, name: str) -> list[int]:
        """Delete the versions a rebuild has replaced: once no reader of them is left."""
        info = self.info(name)
        fs, path = hadoop_path(self.spark, f"{self.root}/{name}")
        found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
        old = sorted(int(p.getName()[2:]) for p in found if int(p.getName()[2:]) < info.version)
        for version in old:
            fs.delete(hadoop_path(self.spark, f"{self.root}/{name}/v={version}")[1], True)
        return old

    def columns(self, spec: TableSpec | str) -> DataFrame:
        """Column names and types in order."""
        rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(self.read(spec).schema.fields)]
        return local_frame(self.spark, rows, "ordinal int, column_name string, data_type string")


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns as they are, then the new ones; nothing is retyped or dropped."""
    known = {f.name for f in old.fields}
    return T.StructType(old.fields + [f for f in new.fields if f.name not in known])
