"""Test items inside long documents: MinHash containment search over items partitioned by size, then exact shingles.

Items are split by the number of their shingles into classes (u/2, u]. A document is read as overlapping windows of 1.5 u
shingles at steps of u/2, so any passage of u shingles lies inside one window, and a contained item has a Jaccard
similarity of at least 0.4 u / 1.6 u = 0.25 to that window, however long the document is. With ``functions`` = 64 minima and
one equal minimum enough, a contained item is missed with probability 0.75^64, or 1e-8. Every (document, item) found so is
verified: the share of the item's distinct shingles that the whole document has.

The minima of a class are taken from blocks, and those of a larger class from the blocks of the next smaller one, so a
shingle is hashed once. Documents are read in streams of some thousand shingles; a window that crosses the end of a
document stands for both. Signatures of items are sent to the tasks in rounds of at most ``round_bytes`` of item text, so
what is sent is bounded whatever the number of items; more items cost more passes. Nothing is shuffled.

Defined results: null and empty items and documents match nothing; an item of fewer than five words is one shingle and
matches documents of these very words; equal documents and items each give their pairs; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import batches, id_and_bytes, mixed, released, shingle_hashes, slices, word_hashes

WIDTH = 5
_PAIRS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_shingles", pa.int64())])


class ItemIndex:
    """Minima of the items by size class. ``sets`` are the items' distinct shingles."""

    def __init__(self, item_ids: list, texts: list[bytes], functions: int):
        sets = [np.unique(shingle_hashes(word_hashes(t), WIDTH)) for t in texts]
        kept = [k for k, s in enumerate(sets) if len(s)]
        self.item_ids, self.sets = [item_ids[k] for k in kept], [sets[k] for k in kept]
        seeds = mixed(np.arange(1, 2 * functions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.odd, self.shift = (seeds[:functions] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), seeds[functions:].astype(np.uint32)
        self.classes: dict[int, dict] = {}
        for k, s in enumerate(self.sets):
            u = max(4, 1 << (len(s) - 1).bit_length())
            self.classes.setdefault(u, {"items": []})["items"].append(k)
        for found in self.classes.values():
            minima = np.array([self.hashed(self.sets[k]).min(axis=1) for k in found["items"]])
            size = 1 << (64 * len(minima)).bit_length()
            seen = np.zeros((functions, size), bool)
            seen[np.arange(functions), minima & np.uint32(size - 1)] = True
            found.update(minima=minima, seen=seen, low=np.uint32(size - 1))

    def hashed(self, shingles: np.ndarray) -> np.ndarray:
        return self.odd[:, None] * shingles.astype(np.uint32)[None, :] + self.shift[:, None]

    def windows(self, shingles: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first, end): items with a minimum of the window of shingles first to end."""
        if not len(self.classes) or not len(shingles):
            return
        block, minima = 1, self.hashed(shingles)
        rows = np.arange(len(self.odd))[:, None]
        for u in sorted(self.classes):
            while block < u // 2:  # two neighbouring blocks make one of the next size
                odd = minima.shape[1] % 2
                pairs = np.minimum(minima[:, 0 : minima.shape[1] - odd : 2], minima[:, 1::2])
                minima = np.concatenate([pairs, minima[:, -1:]], axis=1) if odd else pairs
                block *= 2
            w = minima.copy()
            for step in (1, 2):
                if minima.shape[1] > step:
                    np.minimum(w[:, :-step], minima[:, step:], out=w[:, :-step])
            found = self.classes[u]
            for f, k in np.argwhere(found["seen"][rows, w & found["low"]]).tolist():
                for i in np.flatnonzero(found["minima"][:, f] == w[f, k]).tolist():
                    yield found["items"][i], k * block, (k + 3) * block


def _verified(index: ItemIndex, doc_ids: list, sets: list[np.ndarray], min_share: float) -> Iterator[tuple]:
    ends = np.cumsum([len(s) for s in sets])
    wanted = set()
    for item, first, end in index.windows(np.concatenate(sets) if sets else np.empty(0, np.uint64)):
        d = int(np.searchsorted(ends, first, "right"))
        while d < len(sets) and (d == 0 or ends[d - 1] < end):
            wanted.add((d, item))
            d += 1
    distinct = {d: np.unique(sets[d]) for d, _ in wanted}
    for d, item in sorted(wanted):
        shingles = index.sets[item]
        at = np.searchsorted(distinct[d], shingles)
        shared = int((distinct[d][np.minimum(at, len(distinct[d]) - 1)] == shingles).sum()) if len(distinct[d]) else 0
        if shared >= min_share * len(shingles):
            yield doc_ids[d], index.item_ids[item], shared, len(shingles)


def _rounds(items: DataFrame, round_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """The items, some ``round_bytes`` of text at a time, as ids and texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = -(-total // round_bytes) or 1
    for k in range(rounds):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k).collect()
        yield [r["item_id"] for r in own], [bytes(r["text"]) for r in own]


def _streams(texts: Iterable[bytes], stream: int) -> Iterator[list[np.ndarray]]:
    """The shingles of whole texts, some ``stream`` of them at a time."""
    sets, held = [], 0
    for text in texts:
        sets.append(shingle_hashes(word_hashes(text), WIDTH))
        held += len(sets[-1])
        if held >= stream:
            yield sets
            sets, held = [], 0
    yield sets


def contained_items(
    docs: DataFrame, items: DataFrame, min_share: float = 0.8, functions: int = 64, round_bytes: int = 8 << 20,
    stream: int = 4096,
) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment of every item of which a document has ``min_share``."""

    def searched(sent) -> DataFrame:
        def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, functions)
            for batch in (s for part in parts for s in slices(part)):
                found, doc_ids, at = [], batch.column("doc_id").to_pylist(), 0
                for sets in _streams(batch.column("text").to_pylist(), stream):
                    found += _verified(index, doc_ids[at : at + len(sets)], sets, min_share)
                    at += len(sets)
                columns = zip(*found) if found else ((),) * len(_PAIRS)
                yield batches(dict(zip(_PAIRS.names, map(list, columns))), _PAIRS)

        return id_and_bytes(docs).mapInArrow(released(run), "doc_id long, item_id long, n_shared long, n_shingles long")

    send = docs.sparkSession.sparkContext.broadcast
    pairs = reduce(DataFrame.unionByName, [searched(send(r)) for r in _rounds(items, round_bytes)])
    return pairs.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def without_items(
    docs: DataFrame, items: DataFrame, min_share: float = 0.8, functions: int = 64, round_bytes: int = 8 << 20,
    stream: int = 4096,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns as they are."""
    at = docs.columns.index("text")

    def cleared(rest: DataFrame, sent) -> DataFrame:
        def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*sent.value, functions)
            for batch in parts:
                keep, start = np.ones(len(batch), bool), 0
                texts = ((t.as_py() or "").encode() for t in batch.column(at))
                for sets in _streams(texts, stream):
                    rows = list(range(start, start + len(sets)))
                    keep[[row for row, *_ in _verified(index, rows, sets, min_share)]] = False
                    start += len(sets)
                yield batch.filter(pa.array(keep))

        return rest.mapInArrow(released(run), docs.schema)

    send = docs.sparkSession.sparkContext.broadcast
    return reduce(cleared, [send(r) for r in _rounds(items, round_bytes)], docs)


ORACLE = r"""
WITH s AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
g AS (SELECT DISTINCT side, id, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM s WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM g WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n) AS n_shingles, count(*) / any_value(n) AS containment
FROM g d JOIN g i USING (g) JOIN n ON n.id = i.id
WHERE d.side = 'd' AND i.side = 'i' GROUP BY ALL HAVING count(*) >= 0.8 * any_value(n)
"""
