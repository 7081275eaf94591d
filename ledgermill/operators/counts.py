"""Row counts of many tables in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import local_frame


def source_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def table_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """``pg_table, row_count``; NULL for a table that is absent. The counts read no columns, only file metadata."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("pg_table"), "row_count")
        for name, df in tables.items()
        if df is not None
    ]
    absent = [(name, None) for name, df in tables.items() if df is None]
    if absent or not parts:
        parts.append(local_frame(spark, absent, "pg_table string, row_count bigint"))
    return reduce(DataFrame.unionByName, parts)


def total_records(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_records"))
