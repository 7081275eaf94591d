"""What the corpus operators share: columns of documents, staging, word and shingle hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """doc_id and the text as UTF-8 bytes; a null text is empty. Other columns are left out, whatever their names."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends at files that outlive an executor."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Arrow batches end at a few MB, unless the session has a size of its own: what Spark holds outside its heap for
    them follows their size, in each task that has ever run Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def batches(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def decoded(text: bytes) -> str:
    """Bytes that are not UTF-8 read as U+FFFD."""
    return text.decode("utf-8", "replace")


def slices(batch: pa.RecordBatch, budget: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the texts in it pass a number of bytes, so that working memory follows the longest text."""
    sizes = np.diff(np.frombuffer(batch.column("text").buffers()[1], np.int32)[batch.column("text").offset :][: len(batch) + 1])
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > budget:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(batch):
        yield batch.slice(start)


class Remembered(dict):
    """A dict that computes missing values; emptied when it holds ``limit`` entries, so its memory is bounded."""

    def __init__(self, function, limit: int = 300_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


WORD_HASHES = Remembered(xxhash.xxh3_64_intdigest)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, in order."""
    words = text.lower().split()
    return np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows of ``width`` words in order; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    width = min(width, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64) * _M1
    for i in range(width):
        h = mixed(h * _M1 + words[i : len(words) - width + 1 + i])
    return h


def give_back() -> None:
    """Forget the remembered hashes, and return memory that is free to the system."""
    WORD_HASHES.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` of a ``mapInArrow``, after which a worker that Spark uses again holds little more than a new one: what its rows
    and remembered values took is not added to what the next operators take."""

    def whole(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(rows)
        give_back()

    return whole


def chunked(rows: Iterable, size: int) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def crc32_sql(value: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an integer in decimals; it has no function for it."""
    return f"""xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)))"""
