"""Size checks behind every choice of a broadcast."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = {"b": 1, "kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit for broadcasting a table, in bytes; 0 when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").strip().lower()
    digits = text.rstrip("bkmg")
    return max(0, int(digits) * UNITS[text[len(digits):] or "b"])


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of a plan after column pruning: what Spark itself compares with the limit."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> Column:
    """What a row takes in memory, as an expression to sum: a word per column and the bytes of its texts and lists."""
    fixed = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    texts = [F.octet_length(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lists = [32 * F.size(f.name) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return reduce(add, [F.coalesce(size, F.lit(0)) for size in texts + lists], fixed)


def fits_broadcast(df: DataFrame) -> bool:
    return plan_bytes(df) <= broadcast_limit(df.sparkSession)
