"""Lines that stand in many documents go everywhere but in the last document that has them.

A line's key is the line without white space at its ends and with A-Z in lower case; keys under ``min_chars`` code points are
never touched. Two Bloom filters find the candidates: a task owns a share of the key hashes, one filter holds the hashes it
has met once and the other those it has met twice, and a hash met again after that is a suspect. Before hashes are sent, equal
ones of a slice of texts are put together (up to three count), so a line of a third of all documents is one row per slice.

The suspects of all tasks make one more filter, of ``filter_words`` 64-bit words whatever the input; it is the only thing
that passes through the driver and the only broadcast. Texts without a suspected line are done after a look at it. Of the
others only the suspected keys, as SHA-256, meet in a shuffle, which counts their documents exactly and finds the largest
doc_id. Filters err to one side: more lines than they are laid out for mean more suspects to count, never other results.

Defined results: a null or empty text is one empty line; rows with the same doc_id are one document, and so are all rows
without one, which come before every id; lines of the last document stay, repeated or not; repeated rows give a row
each; an empty table gives no rows; texts are taken a slice at a time, a very long one alone; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_bytes, mixed, slices, stage

MIN_DOCS, MIN_CHARS = 3, 20
TASK_WORDS, FILTER_WORDS = 1 << 20, 1 << 19
_BITS = 4
_CONTINUATION = bytes(range(0x80, 0xC0))
_SEEN = pa.schema([("hash", pa.int64()), ("times", pa.int32())])
_WORDS = pa.schema([("word", pa.int64()), ("bits", pa.int64())])
_MARKED = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("n_lines", pa.int64()), ("suspects", pa.list_(pa.binary()))])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.binary())])
_DDL = "doc_id long, n_lines long, n_dropped long, text binary"


class Bloom:
    """A blocked Bloom filter: the bits of a hash all lie in one 64-bit word. Its size never changes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(hashes)
        bits = np.zeros(len(h), np.uint64)
        for i in range(_BITS):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
        return (h >> np.uint64(24)) % np.uint64(len(self.words)), bits

    def has(self, places: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return self.words[places[0]] & places[1] == places[1]

    def add(self, places: tuple[np.ndarray, np.ndarray], which: np.ndarray) -> None:
        np.bitwise_or.at(self.words, places[0][which], places[1][which])


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def counts_as_line(key: bytes, min_chars: int) -> bool:
    """Whether the key has ``min_chars`` code points; of UTF-8 only those bytes count that begin one."""
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.translate(None, _CONTINUATION)) >= min_chars)


def _keys(text: bytes, min_chars: int) -> list[bytes]:
    return [k for k in map(line_key, text.split(b"\n")) if counts_as_line(k, min_chars)]


def _texts(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        yield from slices(batch)


def _hashed(min_chars: int, enough: int):
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _texts(stream):
            own = [xxhash.xxh3_64_intdigest(k) for t in piece.column("text") for k in set(_keys(t.as_py(), min_chars))]
            hashes, times = np.unique(np.array(own, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([hashes.view(np.int64), np.minimum(times, enough).astype(np.int32)], schema=_SEEN)

    return run


def _met_again(task_words: int, filter_words: int):
    """Hashes met three times by the two filters, as words of the filter of suspects."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (Bloom(np.zeros(task_words, np.uint64)) for _ in range(2))
        suspects = Bloom(np.zeros(filter_words, np.uint64))
        for batch in stream:
            hashes, back = np.unique(batch.column("hash").to_numpy().view(np.uint64), return_inverse=True)
            times = np.bincount(back, batch.column("times").to_numpy(), len(hashes))
            at = once.places(hashes)
            times += once.has(at)
            times += twice.has(at)
            suspects.add(suspects.places(hashes), times >= 3)
            once.add(at, times >= 1)
            twice.add(at, times >= 2)
        found = np.flatnonzero(suspects.words)
        for part in np.array_split(found, -(-len(found) // 50_000) or 1):
            yield pa.RecordBatch.from_arrays([part, suspects.words[part].view(np.int64)], schema=_WORDS)

    return run


def suspects_filter(docs: DataFrame, min_chars: int = MIN_CHARS, filter_words: int = FILTER_WORDS) -> np.ndarray:
    """The words of a Bloom filter that holds each key of three or more rows. ``docs``: doc_id, text as bytes."""
    spark = docs.sparkSession
    seen = docs.mapInArrow(_hashed(min_chars, 3), "hash long, times int")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = seen.repartition(tasks, "hash").mapInArrow(_met_again(TASK_WORDS, filter_words), "word long, bits long")
    table = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(filter_words, np.uint64)
    words[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return words


def _marked(shared: Broadcast, min_chars: int):
    """The rows with the SHA-256 of the keys that the filter suspects."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        suspected = Bloom(shared.value)
        for piece in _texts(stream):
            texts = [t.as_py() for t in piece.column("text")]
            keys = [list(dict.fromkeys(_keys(t, min_chars))) for t in texts]
            every = list(itertools.chain.from_iterable(keys))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, every), np.uint64, len(every))
            hit = iter(suspected.has(suspected.places(hashes)).tolist())
            marks = [[hashlib.sha256(k).digest() for k in own if next(hit)] for own in keys]
            columns = [piece.column("doc_id"), piece.column("text"), pa.array([t.count(b"\n") + 1 for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(marks, pa.list_(pa.binary()))], schema=_MARKED)

    return run


def _dropped(min_chars: int):
    """The rows without the lines whose key is in ``common``."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for piece in _texts(stream):
            rows = []
            for doc_id, text, common in zip(*(piece.column(c) for c in ("doc_id", "text", "common"))):
                lines, gone = text.as_py().split(b"\n"), set(common.as_py() or ())

                def stays(line: bytes) -> bool:
                    key = line_key(line)
                    return not counts_as_line(key, min_chars) or hashlib.sha256(key).digest() not in gone

                kept = list(filter(stays, lines)) if gone else lines
                rows.append((doc_id.as_py(), len(lines), len(lines) - len(kept), b"\n".join(kept)))
            columns = zip(*rows) if rows else [[]] * len(_KEPT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KEPT)], schema=_KEPT)

    return run


def common_keys(pairs: DataFrame, min_docs: int) -> DataFrame:
    """key, keep (the largest doc_id that has it) of the keys of ``min_docs`` documents or more. ``pairs``: doc_id, key."""
    found = pairs.groupBy("key").agg(
        F.count_distinct("doc_id").alias("n"), F.max(F.col("doc_id").isNull().cast("int")).alias("nameless"), F.max("doc_id").alias("keep")
    )
    return found.where(F.col("n") + F.col("nameless") >= min_docs).select("key", "keep")


def without_common_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, filter_words: int = FILTER_WORDS
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left, of every row."""
    if min_docs < 3:
        raise ValueError("the filters suspect what is met three times; min_docs is 3 at least")
    docs = id_and_bytes(docs)
    shared = docs.sparkSession.sparkContext.broadcast(suspects_filter(docs, min_chars, filter_words))
    marked = docs.mapInArrow(_marked(shared, min_chars), "doc_id long, text binary, n_lines long, suspects array<binary>")
    clean = marked.where(F.size("suspects") == 0).select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), "text")
    suspected = marked.where(F.size("suspects") > 0).withColumn("text_key", F.sha2("text", 256))
    suspected = stage(suspected, "suspected-lines")
    pairs = suspected.select("doc_id", "text_key", F.explode("suspects").alias("key"))
    common = stage(common_keys(pairs, min_docs), "common-lines")
    drops = pairs.join(common, "key").where(~F.col("doc_id").eqNullSafe(F.col("keep")))
    drops = drops.groupBy("doc_id", "text_key").agg(F.collect_set("key").alias("common"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
    rows = suspected.alias("a").join(drops.alias("b"), same, "left").select("a.doc_id", "a.text", "b.common")
    left = rows.mapInArrow(_dropped(min_chars), _DDL)
    return clean.unionByName(left).withColumn("text", F.col("text").cast("string"))


def digests(kept: DataFrame) -> DataFrame:
    """The counts with the SHA-256 of the text that is left."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
j AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keep AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""
