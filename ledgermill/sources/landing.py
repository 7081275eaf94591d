"""Landed extracts: JSON lines per table, in one folder per extract.

    <root>/<table>/landed_batch=<n>/*.json      the n-th extract, never changed once it is there
    <root>/<table>/*.json                       also accepted: one extract, number 0
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.cleaning import clean, raw_schema
from ledgermill.session import hadoop_path, local_frame, path_exists
from ledgermill.specs import TableSpec

BATCH = "landed_batch"


def raw_records(lines: DataFrame, spec: TableSpec, number: int = 0) -> DataFrame:
    """Landed JSON lines to the configured fields as they are, ``_has`` and ``_batch``.

    ``_has`` names the fields that the record carries, sorted: a field left out is not the same as one without a value. The
    extract number is that of the file's folder, or ``number``. The keys of an object are only looked up where a field is null.
    """
    schema = raw_schema(spec)
    batch = F.regexp_extract("_metadata.file_path", rf"/{BATCH}=(\d+)/", 1).try_cast("bigint")
    every = F.array(*[F.lit(f) for f in sorted(schema.names)])
    records = lines.where(F.length(F.trim("value")) > 0).select(
        F.from_json("value", schema).alias("record"), "value", F.coalesce(batch, F.lit(number).cast("bigint")).alias("_batch")
    )
    whole = reduce(Column.__and__, [F.col("record")[f].isNotNull() for f in schema.names], F.col("value").startswith("{"))
    has = F.when(whole, every).otherwise(F.array_intersect(every, F.json_object_keys("value")))
    return records.select("record.*", has.alias("_has"), "_batch")


class Landing:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def exists(self, spec: TableSpec) -> bool:
        return path_exists(self.spark, self.path(spec))

    def batches(self, spec: TableSpec) -> list[int]:
        """The extracts that have landed, in order; empty for a folder without extract folders."""
        fs, path = hadoop_path(self.spark, self.path(spec))
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))

    def folders(self, spec: TableSpec, after_batch: int | None = None, upto: int | None = None) -> list[str]:
        batches = self.batches(spec)
        if not batches:
            return [self.path(spec)] if after_batch is None else []
        wanted = [b for b in batches if (after_batch is None or b > after_batch) and (upto is None or b <= upto)]
        return [f"{self.path(spec)}/{BATCH}={b}" for b in wanted]

    def resolve(self, spec: TableSpec) -> TableSpec:
        """The spec with its fields; one without a field list takes every field the records have."""
        if spec.fields:
            return spec.with_keys()
        lines = self.spark.read.text(self.path(spec))
        names = lines.select(F.explode(F.json_object_keys("value")).alias("name")).distinct()
        found = [r.name for r in names.orderBy("name").collect() if not r.name.endswith("_ids")]
        return TableSpec(**{**spec.__dict__, "fields": tuple(found)}).with_keys()

    def raw(self, spec: TableSpec, after_batch: int | None = None, upto: int | None = None) -> DataFrame:
        """The raw records of the extracts after ``after_batch``; the folders of older ones are not even listed."""
        folders = self.folders(spec, after_batch, upto)
        if not folders:
            schema = T.StructType([*raw_schema(spec).fields, *T.StructType.fromDDL("_has array<string>, _batch bigint").fields])
            return local_frame(self.spark, [], schema)
        return raw_records(self.spark.read.text(folders), spec)

    def read(self, spec: TableSpec, after_batch: int | None = None, upto: int | None = None) -> DataFrame:
        """Typed records with ``_batch``, ``_has`` and ``_bad``."""
        return clean(self.raw(spec, after_batch, upto), spec, keep=("_batch", "_has"))

    def field_catalogue(self, spec: TableSpec) -> DataFrame:
        """Per field of the records, sorted by name: the declared type (``?`` if none) and the types that were seen."""
        declared = {f.name: f.dataType.simpleString() for f in spec.with_keys().schema().fields}
        kinds = local_frame(self.spark, declared.items(), "field string, declared string")
        values = self.spark.read.text(self.path(spec)).select(F.try_parse_json("value").alias("v"))
        seen = values.lateralJoin(
            self.spark.tvf.variant_explode(F.col("v").outer()).select(
                F.col("key").alias("field"), F.schema_of_variant("value").alias("seen")
            )
        )
        seen = seen.groupBy("field").agg(F.array_join(F.sort_array(F.collect_set("seen")), ", ").alias("seen"))
        return (
            kinds.join(seen, "field", "full_outer")
            .select("field", F.coalesce("declared", F.lit("?")).alias("type"), "seen")
            .orderBy("field")
        )


def missing_sources(registry: DataFrame, available: DataFrame) -> DataFrame:
    """Each registry entry with ``present``, or ``skipped`` where the source has no such model."""
    there = available.select("model_name").distinct().withColumn("_there", F.lit(True))
    return registry.join(there, "model_name", "left").select(
        "model_name",
        "pg_table",
        F.when(F.col("_there"), F.lit("present")).otherwise(F.lit("skipped")).alias("status"),
    )


def available_sources(landing: Landing, specs: Iterable[TableSpec]) -> DataFrame:
    rows = [(s.model,) for s in specs if landing.exists(s)]
    return local_frame(landing.spark, rows, "model_name string")
