"""Load logs: text files with one event per line, where a traceback spans the lines after its event.

Lines are read in splits, so one large file is as parallel as many small ones. A compressed file cannot be split and is read by
one task, but goes on from there in chunks of lines. What a line inherits from the lines before it is found in two steps:
inside each chunk of a split, and then from the last event of the earlier chunks, of which there is one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The line format "time [LEVEL] logger: message".
EVENT = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d{3}) \[(\w+)\] ([^:\s]+): (.*)$"
TAIL = 500
CHUNK = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, seq, line``, whose first three give the order of the lines of a file, and when it was ``modified``."""
    return spark.read.text(path).select(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def parse_lines(lines: DataFrame, chunk_lines: int = CHUNK) -> DataFrame:
    """``file, line_no, logged_at, level, logger, message``; a line that is no event takes those of the event above."""
    part = lambda n: F.regexp_extract("line", EVENT, n)
    is_event = part(1) != ""
    event = F.struct(
        F.concat(part(1), F.lit("."), part(2)).cast("timestamp_ntz").alias("logged_at"),
        part(3).alias("level"),
        part(4).alias("logger"),
    )
    marked = lines.select(
        "file",
        "block",
        "seq",
        F.call_function("div", F.col("seq"), F.lit(chunk_lines)).alias("chunk"),
        F.when(is_event, event).alias("event"),
        F.when(is_event, part(5)).otherwise(F.col("line")).alias("message"),
    )
    in_block = Window.partitionBy("file", "block", "chunk").orderBy("seq")
    earlier = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        marked.groupBy("file", "block", "chunk")
        .agg(F.count("*").alias("n"), F.max_by("event", F.when(F.col("event").isNotNull(), F.col("seq"))).alias("ended"))
        .select(
            "file",
            "block",
            "chunk",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.last("ended", ignorenulls=True).over(earlier).alias("carried"),
        )
    )
    numbered = marked.select(
        "*",
        F.row_number().over(in_block).alias("n"),
        F.last("event", ignorenulls=True).over(in_block).alias("latest"),
    )
    event = F.coalesce("latest", "carried")
    return numbered.join(blocks, ["file", "block", "chunk"]).select(
        "file",
        (F.col("before") + F.col("n")).alias("line_no"),
        event["logged_at"].alias("logged_at"),
        event["level"].alias("level"),
        event["logger"].alias("logger"),
        "message",
    )


def log_tail(lines: DataFrame, count: int = TAIL) -> DataFrame:
    """The last lines: of the file that was written last first, and not of the one whose name sorts last.

    A rotated file has an older time than the current one. Lines without ``modified`` are ordered by the rest.
    """
    order = [c for c in ("modified", "file", "block", "seq") if c in lines.columns]
    return lines.orderBy(*[F.desc(c) for c in order]).limit(count).orderBy(*order)
