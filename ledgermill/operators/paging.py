"""Reading part of a table in id order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators.store import range_of

RECENT_COLUMNS = 15
RECENT_ROWS = 20


def scan_page(
    df: DataFrame,
    fields: Sequence[str] = (),
    offset: int = 0,
    limit: int | None = None,
    order: Sequence[str] = ("id",),
) -> DataFrame:
    """A page of records. Loading a table never pages; this serves a reader who looks at a few records."""
    page = df.select(*fields) if fields else df
    if order:
        page = page.orderBy(*order)
    if offset:
        page = page.offset(offset)
    return page.limit(limit) if limit else page


def recent_rows(df: DataFrame, rows: int = RECENT_ROWS, columns: int = RECENT_COLUMNS) -> DataFrame:
    """The rows with the highest ids, first columns only. For a stored table pass its ``TableStore.tail``.

    The id column alone gives the lowest id to show; that bound then prunes the scan of the other columns to the row
    groups at the end of the table.
    """
    names = df.columns[:columns]
    bound = df.select("id").orderBy(F.desc("id")).limit(rows).agg(F.min("id"))
    return df.select(*names).where(F.col("id") >= bound.scalar()).orderBy(F.desc("id")).limit(rows)


def record_cap(df: DataFrame, cap: int, batch_size: int = 500, width: int = 100_000) -> DataFrame:
    """The first records by id up to ``cap``, rounded up to whole batches; 0 keeps all.

    An id is kept with all its records or not at all, so a reader who goes on after the last id misses none. Counts per id
    range find the range where the cap falls, and counts per id in that one range the last id to keep; the records
    themselves are only filtered, so neither a large cap nor an id with very many records passes through one task.
    """
    if not cap:
        return df
    keep = -(-cap // batch_size) * batch_size
    ranged = df.where("id is not null").select("id", range_of("id", width).alias("_range"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("n"))
    edge, before = _reached(counts, "_range", keep)
    if edge is None:
        return df.limit(0)
    ids = ranged.where(F.col("_range") == edge).groupBy("id").agg(F.count("*").alias("n"))
    last, _ = _reached(ids, "id", keep - before)
    return df.where(F.col("id") <= last)


def _reached(counts: DataFrame, key: str, keep: int) -> tuple[int | None, int | None]:
    """The last key that begins before ``keep`` records in key order, and how many stand before it; a row per key."""
    before = F.sum("n").over(Window.orderBy(key)) - F.col("n")
    reached = counts.select(key, before.alias("before")).where(F.col("before") < keep)
    return tuple(reached.agg(F.max(key), F.max_by("before", key)).first())
