"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put the settings the package counts on onto a session builder. Sizes are left to the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="ledgermill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the scratch folder; ``clear_scratch`` removes what is there, at the latest when the driver ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_clear_at_exit)
    _MADE.append(path)
    return path


_MADE: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch files of this driver: once no DataFrame that reads them is needed any more."""
    gone = 0
    while _MADE:
        fs, path = hadoop_path(spark, _MADE.pop())
        gone += fs.delete(path, True)
    return gone


def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        clear_scratch(spark)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for the few metadata calls Spark SQL has no verb for."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver rows as a DataFrame. By way of Arrow they become a local table, with no Python task behind it."""
    schema = spark_schema(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


def spark_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


class Staged:
    """A DataFrame written to the scratch folder and read back: the lineage ends at shared files.

    Several jobs then read columnar files instead of repeating the parse, and a lost executor costs a re-read.
    ``facts`` are aggregates of the rows, gathered while they are written; the columns ``unwritten`` serve them only. Used as
    a context manager; the files go when the block ends well, and stay for a repair when it does not.
    """

    def __init__(self, df: DataFrame, label: str, facts: Sequence[Column], unwritten: Sequence[str] = ()):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        self.seen = Observation()
        self.source = df.observe(self.seen, *facts).drop(*unwritten)
        self.schema = self.source.schema

    def __enter__(self) -> Staged:
        self.source.write.parquet(self.path)
        return self

    @property
    def facts(self) -> dict:
        return self.seen.get

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            fs, jpath = hadoop_path(self.spark, self.path)
            fs.delete(jpath, True)
