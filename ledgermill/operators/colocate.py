"""Copies of tables that joins on one key read without a shuffle.

A table is kept in ranges of its id, which suits upserts. A view that joins lines to headers shuffles the lines by their
header for every query; a copy that is bucketed and sorted by the header's id, and known to the catalog as such, is
shuffled once, when it is made. Both sides need the same number of buckets. A copy holds the table as it was then.

A bucket is one task of the join, and cannot be split there: ``buckets_for`` chooses their number by the size of the tables.
Join a table where one header has a large part of the lines without a copy, so that the adaptive plan can split it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.sizes import row_bytes
from ledgermill.operators.store import TableStore
from ledgermill.session import hadoop_path
from ledgermill.specs import TableSpec


BUCKET_BYTES = 128 << 20


def buckets_for(*tables: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """Buckets for copies of ``tables`` that are joined: as many as the largest needs for ``bucket_bytes`` of rows in each."""
    sizes = [rows.agg(F.sum(row_bytes(rows)).alias("bytes")).first()["bytes"] or 0 for rows in tables]
    return max(least, -(-max(sizes) // bucket_bytes))


def write_buckets(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``rows`` as the catalog table ``name``: one sorted file per bucket of ``key``."""
    dealt = rows.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def known_buckets(spark: SparkSession, rows: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """The copy at ``path`` in a session whose catalog does not have it; ``rows`` has its columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def colocated(store: TableStore, spec: TableSpec, key: str, buckets: int) -> DataFrame:
    """A new copy of a stored table by ``key``, beside its ranges; earlier ones are removed by ``drop_copies``."""
    version = uuid.uuid4().hex
    return write_buckets(store.read(spec), f"{spec.name}_{version}", f"{store.root}/{spec.name}/by_{key}/{version}", key, buckets)


def drop_copies(store: TableStore, spec: TableSpec, key: str, keep: int = 1) -> int:
    """Delete all but the newest copies by ``key``: once no reader of the others is left."""
    fs, folder = hadoop_path(store.spark, f"{store.root}/{spec.name}/by_{key}")
    if not fs.exists(folder):
        return 0
    old = sorted(fs.listStatus(folder), key=lambda s: s.getModificationTime(), reverse=True)[keep:]
    for status in old:
        store.spark.sql(f"DROP TABLE IF EXISTS `{spec.name}_{status.getPath().getName()}`")
        fs.delete(status.getPath(), True)
    return len(old)
