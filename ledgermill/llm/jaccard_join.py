"""Documents whose sets of word n-grams have a Jaccard similarity over a threshold, joined by count-vector R-trees.

Documents with equal sets are one class. The shingles of a class are hashed into ``GROUPS`` groups, and their counts are a
point. Two classes share at most the sum of the smaller coordinates, so a node of an R-tree (its largest counts, its
smallest size) bounds the overlap of everything below it; two trees are walked together, pairs of nodes whose bound is
under the overlap that the threshold asks for are dropped, and the pairs of points that survive are verified on the sets.

An R-tree over all classes would not scale: every coordinate of two unrelated texts is about as close as that of two
copies, and only all of them together tell the texts apart, so its upper levels drop nothing and the walk is quadratic.
Classes are therefore routed to trees by ``BANDS`` keys of three MinHash minima each: a pair over the threshold shares one
with a probability of 1 - (1 - 0.85^3)^24 = 1 - 1e-10. A tree is built for each key.

Links are wanted for their components, and one large group of near copies must not be paired out. First every class is
verified against one pivot of its group for three of the keys, and the links found give labels. Then trees are built only for keys
whose members have different labels, nodes of one same label are not walked, and a point is verified with its closest
partner of another label only. The labels are taken anew, and the trees built again for four partners and then, where some
were left, without a limit, so every link between different components is looked for. Keys with very many such members are cut into tiles, and pairs of tiles are joined as trees of their own.

Defined results: words are those of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words than ``width`` make one
shingle; null and empty texts have none and are their own component; equal rows share a component; a null doc_id keeps
its row and is not a component's id unless all ids are null; an empty table gives no rows; other columns are ignored.
Sets and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import batches, id_and_bytes, mixed, released, shingle_hashes, slices, stage, word_hashes
from ledgermill.llm.components import components

GROUPS, BANDS, ROWS, FANOUT, TILE = 256, 24, 3, 24, 20_000
FULL = 65_535
NO_ID = -(1 << 63)
_SEEDS = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD, _SHIFT = (_SEEDS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), _SEEDS[BANDS * ROWS :].astype(np.uint32)
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64())), ("counts", pa.binary())])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def distinct_shingles(text: bytes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), width))


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    low, least = shingles.astype(np.uint32), np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        least = np.minimum(least, (_ODD[:, None] * low[None, at : at + 2048] + _SHIFT[:, None]).min(axis=1))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    counts = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, FULL).astype("<u2")


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, node (the class), bands, counts per document."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for part in rows for s in slices(part)):
            columns = {f.name: [] for f in _SKETCH} | {"doc_id": batch.column("doc_id")}
            for text in batch.column("text"):
                shingles = distinct_shingles(text.as_py(), width)
                columns["n"].append(len(shingles))
                columns["node"].append(node_of(shingles))
                columns["bands"].append(band_keys(shingles) if len(shingles) else [])
                columns["counts"].append(count_vector(shingles).tobytes())
            yield batches(columns, _SKETCH)

    return id_and_bytes(docs).mapInArrow(released(run), "doc_id long, n long, node long, bands array<long>, counts binary")


class RTree:
    """Points in the order of a bulk load, and levels of nodes of ``FANOUT`` children each, root last."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        spread = np.argsort(-counts.std(axis=0))[:3]
        order = np.lexsort((*(counts[:, c] for c in spread), labels))
        self.order = order
        # Saturated counts stand for any count.
        high = np.where(counts[order] == FULL, sizes[order, None], counts[order]).astype(np.float32)
        low, first, last = sizes[order].astype(np.float32), labels[order], labels[order]
        self.levels = [(high, low, first, last)]
        while len(low) > 1:
            starts = np.arange(0, len(low), FANOUT)
            high, low = np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts)
            first, last = np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts)
            self.levels.append((high, low, first, last))

    def _open(self, level: int, i: np.ndarray, j: np.ndarray, threshold: float, step: int = 4096) -> tuple[np.ndarray, ...]:
        """The pairs of nodes that may hold a link between different labels, and their bounds.

        Two sets of sizes m and n over a threshold t share t / (1 + t) * (m + n) at least, and the smaller has t of the larger.
        """
        share = threshold / (1 + threshold)
        high, low, first, last = self.levels[level]
        kept = (first[i] != last[j]) | (last[i] != first[j])
        i, j = i[kept], j[kept]
        bounds = np.empty(len(i), np.float32)
        for at in range(0, len(i), step):
            bounds[at : at + step] = np.minimum(high[i[at : at + step]], high[j[at : at + step]]).sum(axis=1)
        kept = bounds >= share * (low[i] + low[j]) - 1e-3
        if level == 0:
            kept &= (i < j) & (np.maximum(low[i], low[j]) * threshold <= np.minimum(low[i], low[j]) + 1e-3)
        return i[kept], j[kept], bounds[kept]

    def pairs(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of two points each that may be over the threshold, and the bound of their overlap."""
        i = j = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            i, j, bounds = self._open(level, i, j, threshold)
            if level:
                n = len(self.levels[level - 1][1])
                step = np.arange(FANOUT)
                i, j = (np.broadcast_arrays(i[:, None, None] * FANOUT + step[:, None], j[:, None, None] * FANOUT + step[None, :]))
                i, j = i.ravel(), j.ravel()
                kept = (i < n) & (j < n) & (i <= j)
                i, j = i[kept], j[kept]
        return self.order[i], self.order[j], bounds


def _closest(i: np.ndarray, j: np.ndarray, grade: np.ndarray, limit: int) -> np.ndarray:
    """Of the pairs of each point the ``limit`` with the largest grade; as a mask over pairs."""
    kept = np.zeros(len(i), bool)
    for own in (i, j):
        order = np.lexsort((-grade, own))
        new = np.concatenate([[True], own[order][1:] != own[order][:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        kept[order] |= np.arange(len(order)) - start < limit
    return kept


def _grouped(rows: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches."""
    held, current = [], None
    for batch in rows:
        keys = batch.column(key).to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and keys[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def candidates(nodes: DataFrame, labels: DataFrame, percent: int, limit: int | None) -> DataFrame:
    """a, b: classes of different labels that the trees of their common keys do not tell apart.

    With ``limit`` a point keeps so many partners in each tree; a row of nulls says that some were left for later.
    """
    spark = nodes.sparkSession
    known = nodes.select("node", "n", "bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = known.select("node", "n", "label", F.explode("bands").alias("key"))
    keys = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"))
    keys = keys.where("low != high").select("key", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node"), "tiles").cast("int")
    members = rows.join(stage(keys, "mixed-keys"), "key").withColumn("own", own)
    members = members.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    block = F.xxhash64("key", F.least("own", "tile"), F.greatest("own", "tile"))
    members = members.select(block.alias("block"), "node", "n", "label", "own").join(nodes.select("node", "counts"), "node")

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(parts, "block"):
            if len(group) < 2:
                continue
            node, sizes, label, tile = (group.column(c).to_numpy() for c in ("node", "n", "label", "own"))
            counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), "<u2").reshape(-1, GROUPS)
            i, j, bounds = RTree(counts, sizes, label).pairs(percent / 100)
            kept = np.ones(len(i), bool) if tile.min() == tile.max() else tile[i] != tile[j]
            i, j, bounds = i[kept], j[kept], bounds[kept]
            if not len(i):
                continue
            if limit:
                kept = _closest(i, j, bounds / (sizes[i] + sizes[j]), limit)
                if not kept.all():
                    yield batches({"a": [None], "b": [None]}, _PAIR)  # says that there is more
                i, j = i[kept], j[kept]
            yield batches({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])}, _PAIR)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = members.repartition(parts, "block").sortWithinPartitions("block", "node")
    return placed.mapInArrow(released(run), "a long, b long").distinct()


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose sets are over the threshold. A set is computed once and sent once per 16 partners of a node."""
    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stage(wanted.join(nodes.select("node", "first_id"), "node").select("node", "first_id"), "wanted")

    def compute(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
        for batch in rows:
            found = [distinct_shingles(t.as_py(), width) for t in batch.column("text")]
            yield batches({"node": [node_of(s) for s in found], "shingles": [s.tobytes() for s in found]}, schema)

    texts = id_and_bytes(docs).withColumn("first_id", F.coalesce("doc_id", F.lit(NO_ID)))
    texts = texts.join(wanted.select("first_id").distinct(), "first_id").select("text")
    # Rows of equal ids may have other texts, and rows of equal texts come more than once.
    sets = texts.mapInArrow(released(compute), "node long, shingles binary").dropDuplicates(["node"]).join(wanted.select("node"), "node", "left_semi")
    sets = stage(sets, "sets")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int"))
    lead = salted.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a")
    lead = lead.select("a", "salt", F.lit(None).cast("long").alias("b"), "shingles")
    other = salted.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "shingles")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.empty(0, np.uint64)
        for batch in rows:
            found = {"a": [], "b": []}
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "shingles"))
            for a, b, data in zip(*columns):
                shingles = np.frombuffer(data, np.uint64)
                if b is None:
                    first = shingles
                    continue
                at = np.minimum(np.searchsorted(first, shingles), len(first) - 1)
                common = int((first[at] == shingles).sum())
                if 100 * common >= percent * (len(first) + len(shingles) - common):
                    found["a"].append(a)
                    found["b"].append(b)
            yield batches(found, _PAIR)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = lead.unionByName(other).repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return placed.mapInArrow(released(run), "a long, b long")


def links(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links a, b between classes: enough of them that their components are those of all links."""
    spread = nodes.select("node", F.explode(F.slice("bands", 1, 3)).alias("key"))
    pivots = spread.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    pairs = spread.join(pivots, "key").where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    tested = stage(pairs.distinct(), "pivot-pairs")
    found = stage(verified(tested, nodes, docs, width, percent), "pivot-links")
    for limit in (1, 4, None):
        more = stage(candidates(nodes, components(found), percent, limit), "tree-pairs")
        rest = not more.where("a IS NULL").isEmpty()
        more = stage(more.where("a IS NOT NULL").join(tested, ["a", "b"], "left_anti"), "new-pairs")
        tested = tested.unionByName(more)
        found = found.unionByName(stage(verified(more, nodes, docs, width, percent), "tree-links"))
        if not rest:
            break
    return found


def near_groups(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (equal sets) for every document; component_id is its smallest doc_id."""
    rows = stage(sketches(docs, width), "sketches")
    known = rows.where("n > 0").withColumn("first_id", F.coalesce("doc_id", F.lit(NO_ID)))
    real = F.min(F.when(F.col("first_id") != NO_ID, F.col("first_id")))
    nodes = known.groupBy("node").agg(
        F.coalesce(real, F.lit(NO_ID)).alias("first_id"), F.min("n").alias("n"), F.first("bands").alias("bands"), F.first("counts").alias("counts")
    )
    nodes = stage(nodes, "classes")
    labelled = nodes.select("node", "first_id").join(components(links(nodes, docs, width, percent)), "node", "left")
    labelled = stage(labelled.withColumn("label", F.coalesce("label", "node")), "class-labels")
    ids = labelled.groupBy("label").agg(F.min(F.when(F.col("first_id") != NO_ID, F.col("first_id"))).alias("component_id"))
    ids = labelled.join(ids, "label").select("node", "component_id")
    joined = rows.select("doc_id", "n", "node").join(stage(ids, "components"), "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("node").alias("class_id"))


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest doc_id; documents without a word stay.

    Rows of one id are all kept or all dropped; the columns are those of ``docs``.
    """
    groups = near_groups(docs, width, percent)
    gone = groups.where((F.col("n_shingles") > 0) & (F.col("component_id") != F.col("doc_id"))).select("doc_id").distinct()
    return docs.join(stage(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)
