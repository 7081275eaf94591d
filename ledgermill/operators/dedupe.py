"""One row per key, the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PLACE = ("id_bucket", "id_slice")
KEYS = ("id", "write_date", *PLACE)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in the given order.

    Spark limits every group to one row in each map task before the shuffle, so a key with a third of all rows
    arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def newest_first(columns: Sequence[str], arrival_wins: bool = False) -> list[Column]:
    """The order in which versions of a row replace each other.

    The newest ``write_date`` first and then the latest batch, or the other way round when arrival wins. The content of
    the row settles the rest, so that the choice does not depend on how the rows were read. (The columns themselves and
    not a hash of them: the optimizer would carry the hash as a constraint, and rewrite it once per set of renamed
    columns above.)
    """
    written = [F.col("write_date").desc_nulls_last()] if "write_date" in columns else []
    arrived = [F.col("_batch").desc_nulls_last()] if "_batch" in columns else []
    content = [F.col(c).desc() for c in columns if not c.startswith("_") and c not in KEYS]
    return (arrived + written if arrival_wins else written + arrived) + content


def dedupe_latest(df: DataFrame, arrival_wins: bool = False) -> DataFrame:
    """Last write wins: one row per ``id``."""
    return latest_per_key(df, ["id"], newest_first(df.columns, arrival_wins))

