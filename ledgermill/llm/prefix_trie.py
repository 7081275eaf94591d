"""A trie of conversations, peeled from its deepest level.

The conversations that end at the deepest level are its nodes. Level by level, the last turn of every node is taken off, the
nodes are put together with the conversations that end on the level above, and all that have the same turns are one node
there: this grouping finds the nodes of the level and carries their figures (members, leaves, savings) from those below.

A prefix is named by 128 bits that each of its turns (its place, role and text) is folded into by exclusive or, so the name
without the last turn is known from the name with it, and names along a conversation are running sums. Those run over chunks
of CHUNK turns and then over the chunks, so that no task holds a whole conversation. Every row of ``paths`` is one turn.

A level is one grouping, which adds up in each task before its shuffle: a prefix that a third of all conversations share is a
row per task. Deep levels have few turns; as long as levels have ``zone_turns`` turns together or fewer, they make a zone
that is peeled in one pass over rows dealt by the zone's topmost prefix, with no more rows in it than that number.

Names of ended conversations are hashed in order: sorted ranges cut a large set into pieces of text in parallel, and one
task puts the pieces of a node through SHA-256 one after the other, without holding them.

Defined results: rows without conv_id belong to no conversation; a null role or text is empty; null turns come first, and
rows with the same turn are ordered by the SHA-256 of role and text; repeated rows are turns of their own; a conversation that
is left without turns ends at the root; an empty table has no nodes; texts are only hashed; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.llm.common import crc32_sql, stage
from ledgermill.llm.ranks import positions
from ledgermill.session import local_frame, scratch_path

FAMILY, HEADS = 5, 9
CHUNK, ZONE_TURNS, PIECE = 1 << 10, 10_000, 4096
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "depth long, key1 long, key2 long, up1 long, up2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"
_NODE = pa.schema([(c.split()[0], pa.int64()) for c in NODE.split(", ")])
_PIECE = pa.schema([("key1", pa.int64()), ("key2", pa.int64()), ("first", pa.int64()), ("text", pa.string())])
_ENDS = pa.schema([("key1", pa.int64()), ("key2", pa.int64()), ("ends_sha256", pa.string())])


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest and bytes of the turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("read_as"),
    )
    return positions(turns, "conv_id", ["turn", "digest", "read_as"]).select("conv_id", "pos", "digest", "bytes")


def rebuilt_heads(turns: DataFrame) -> DataFrame:
    """conv_id, base, cut (own turns left out), borrowed (turns of the base in their place) and length."""
    own = stage(turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("own")), "conversations")
    cut = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS))
    heads = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), cut.alias("cut"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    heads = heads.join(bases, "base", "left").withColumn("borrowed", F.least("cut", F.coalesce("there", F.lit(0))))
    return heads.select("conv_id", "base", "cut", "borrowed", (F.col("borrowed") + F.greatest(F.col("own") - F.col("cut"), F.lit(0))).alias("length"))


def rebuilt_turns(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """conv_id, length, depth (from 1), digest and bytes of the turns of the rebuilt conversations."""
    borrowed = turns.where(F.col("pos") < HEADS - 1).withColumnRenamed("conv_id", "base").join(heads, "base")
    borrowed = borrowed.where("pos < borrowed").withColumn("depth", F.col("pos") + 1)
    own = turns.join(heads, "conv_id").where("pos >= cut").withColumn("depth", F.col("borrowed") + F.col("pos") - F.col("cut") + 1)
    columns = ["conv_id", "length", "depth", "digest", "bytes"]
    return borrowed.select(*columns).unionByName(own.select(*columns))


def paths(rebuilt: DataFrame) -> DataFrame:
    """conv_id, length, depth, bytes, the name of the prefix that ends here (key1, key2) and that of the one before (up1, up2)."""
    fold = {f"own{k}": F.xxhash64(F.lit(k), "depth", "digest") for k in (1, 2)}
    rows = rebuilt.withColumns(fold | {"chunk": F.shiftright(F.col("depth") - 1, CHUNK.bit_length() - 1)}).drop("digest")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.where(F.col("length") > CHUNK).groupBy("conv_id", "chunk")
    chunks = whole.agg(*[F.bit_xor(f"own{k}").alias(f"own{k}") for k in (1, 2)])
    chunks = chunks.select("conv_id", "chunk", *[F.bit_xor(f"own{k}").over(earlier).alias(f"before{k}") for k in (1, 2)])
    rows = rows.withColumns({f"inside{k}": F.bit_xor(f"own{k}").over(inside) for k in (1, 2)})
    rows = rows.join(chunks.where("chunk > 0"), ["conv_id", "chunk"], "left")
    keys = {f"key{k}": F.col(f"inside{k}").bitwiseXOR(F.coalesce(f"before{k}", F.lit(0))) for k in (1, 2)}
    ups = [F.col(f"key{k}").bitwiseXOR(F.col(f"own{k}")).alias(f"up{k}") for k in (1, 2)]
    return rows.withColumns(keys).select("conv_id", "length", "depth", "bytes", *keys, *ups)


def zones(lengths: dict[int, int], zone_turns: int) -> list[tuple[int, int]]:
    """(low, high) of the zones from the deepest; each has the levels low + 1 to high, one level or ``zone_turns`` turns at most.

    ``lengths``: how many conversations have each length.
    """
    found, high, alive, held = [], max(lengths, default=0), 0, 0
    for depth in range(high, 0, -1):
        alive += lengths.get(depth, 0)
        if depth < high and held + alive > zone_turns:
            found.append((depth, high))
            high, held = depth, 0
        held += alive
    return found + [(0, high)] if high else found


def _grouped(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of a level from ended conversations (n_children 0) and stripped nodes (1 each), which have its names."""
    nodes = rows.groupBy("key1", "key2").agg(
        *[F.max(c).alias(c) for c in ("up1", "up2", "bytes")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")
    saved = F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")
    nodes = nodes.withColumns({"depth": F.lit(depth).cast("long"), "n_leaves": leaves, "saved": saved})
    return nodes.select(*_NODE.names)


def _ended(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_convs", F.lit(1).cast("long")).withColumns({c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved")})


def _stripped(below: DataFrame) -> DataFrame:
    """Nodes as children of the level above, by the conversation that stands for them."""
    return below.select("conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")


def _peeled(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The levels of a zone, of the rows of its conversations that lie in it; n_convs is null where nothing ends or comes in."""
    here, begins = {}, defaultdict(list)
    for batch in stream:
        for r in batch.to_pylist():
            here[r["depth"], r["conv_id"]] = (r["key1"], r["key2"]), (r["up1"], r["up2"]), r["bytes"]
            if r["n_convs"] is not None:
                begins[r["depth"]].append((r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"]))
    below = []
    for depth in sorted({d for d, _ in here}, reverse=True):
        level = defaultdict(list)
        for member in itertools.chain(begins[depth], ((n[5], n[6], 1, n[8], n[9]) for n in below)):
            level[here[depth, member[0]][0]].append(member)
        below = []
        for key, members in level.items():
            conv, (convs, children, leaves, saved) = min(m[0] for m in members), map(sum, list(zip(*members))[1:])
            _, up, size = here[depth, conv]
            below.append((depth, *key, *up, conv, convs, children, leaves if children else 1, saved + (convs - 1) * size))
        for k in range(0, len(below), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*below[k : k + 10_000])], schema=_NODE)


def _zone_nodes(rows: DataFrame, below: DataFrame | None, low: int, high: int) -> DataFrame:
    """The nodes of the levels low + 1 to high. ``rows``: the turns there; ``below``: the nodes of level high + 1."""
    if high - low == 1:
        level = _ended(rows.where(F.col("length") == high)).drop("length", "depth")
        if below is not None:
            level = level.unionByName(rows.drop("length", "depth").join(_stripped(below), "conv_id"))
        return _grouped(level, high)
    figures = ["n_convs", "n_children", "n_leaves", "saved"]
    ends = F.col("depth") == F.col("length")
    member = {c: F.when(ends, int(c == "n_convs")).cast("long") for c in figures}
    if below is not None:
        came = _stripped(below).select("conv_id", *[F.col(c).alias(f"_{c}") for c in figures])
        rows = rows.join(came, "conv_id", "left").where((F.col("length") <= high) | F.col("_n_convs").isNotNull())
        member = {c: F.when(F.col("depth") == high, F.coalesce(f"_{c}", member[c])).otherwise(member[c]) for c in figures}
    rows = rows.withColumns(member)
    conv = Window.partitionBy("conv_id")
    rows = rows.withColumns({f"top{k}": F.min_by(f"key{k}", "depth").over(conv) for k in (1, 2)})
    return rows.repartition("top1", "top2").mapInArrow(_peeled, NODE)


def _pieces(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to rows of up to PIECE ids in one text."""
    done, key, ids = [], None, []

    def close() -> None:
        if ids:
            done.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in stream:
        for own in zip(*(batch.column(c).to_pylist() for c in ("key1", "key2", "conv_id"))):
            if own[:2] != key or len(ids) >= PIECE:
                close()
                key, ids = own[:2], []
            ids.append(own[2])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _PIECE)], schema=_PIECE)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _PIECE)], schema=_PIECE)


def _hashed(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash per key."""
    key, running = None, None
    for batch in stream:
        done = []
        for own in zip(*(batch.column(c) for c in ("key1", "key2", "text"))):
            at, text = (own[0].as_py(), own[1].as_py()), own[2].as_py()
            if at != key:
                if key is not None:
                    done.append((*key, running.hexdigest()))
                key, running = at, hashlib.sha256(text.encode())
            else:
                running.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _ENDS)], schema=_ENDS)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, running.hexdigest()), _ENDS)], schema=_ENDS)


def end_hashes(ended: DataFrame) -> DataFrame:
    """key1, key2 and ends_sha256: the hash of the ids, ascending and joined by commas. ``ended``: key1, key2, conv_id."""
    pieces = ended.repartitionByRange("key1", "key2", "conv_id").sortWithinPartitions("key1", "key2", "conv_id")
    pieces = stage(pieces.mapInArrow(_pieces, "key1 long, key2 long, first long, text string"), "ended")
    dealt = pieces.repartition("key1", "key2").sortWithinPartitions("key1", "key2", "first")
    return dealt.mapInArrow(_hashed, "key1 long, key2 long, ends_sha256 string")


def _zero() -> Column:
    return F.lit(0).cast("long")


def trie(conversations: DataFrame, zone_turns: int = ZONE_TURNS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, see the query's columns."""
    spark = conversations.sparkSession
    turns = turn_rows(conversations)
    heads = stage(rebuilt_heads(turns), "heads")
    lengths = {r.length: r["count"] for r in heads.groupBy("length").count().collect()}
    cuts = zones(lengths, zone_turns)
    folder = scratch_path(spark, "paths")
    numbers = [(d, k) for k, (low, high) in enumerate(cuts) for d in range(low + 1, high + 1)]
    rows = paths(rebuilt_turns(turns, heads)).join(F.broadcast(local_frame(spark, numbers, "depth long, zone long")), "depth")
    rows.hint("rebalance", "zone").write.partitionBy("zone").parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)

    levels, below = [], None
    for k, (low, high) in enumerate(cuts):
        own = stored.where(F.col("zone") == k).drop("zone")
        levels.append(stage(_zone_nodes(own, below, low, high), f"nodes-{low + 1}"))
        below = levels[-1].where(F.col("depth") == low + 1)
    ids = {c: _zero() for c in ("key1", "key2", "bytes")} | {c: F.lit(None).cast("long") for c in ("up1", "up2")}
    turnless = heads.where("length = 0").select("conv_id").withColumns(ids)
    root = _ended(turnless)
    if below is not None:
        root = root.unionByName(_stripped(below).withColumns(ids))
    levels.append(stage(_grouped(root, 0), "nodes-0"))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)

    ended = stored.where(F.col("depth") == F.col("length")).select("key1", "key2", "conv_id")
    ends = end_hashes(ended.unionByName(turnless.select("key1", "key2", "conv_id")))
    parents = nodes.select(F.col("key1").alias("up1"), F.col("key2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.join(ends, ["key1", "key2"], "left").join(parents, ["up1", "up2"], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


_DIGEST = "sha256(strlen(role) || ':' || role || text)"
ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, {_DIGEST} AS digest, strlen(text) AS bytes,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) - 1 AS i FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("conv_id")} % 9 AS h, own
  FROM (SELECT conv_id, count(*) AS own FROM o GROUP BY conv_id)),
b AS (SELECT c.*, least(c.h, coalesce(p.own, 0)) AS borrowed FROM c LEFT JOIN c p ON p.conv_id = c.base),
r AS (SELECT b.conv_id, i + 1 AS d, digest, bytes FROM b JOIN o ON o.conv_id = b.base AND i < borrowed
  UNION ALL SELECT b.conv_id, borrowed + i - h + 1, digest, bytes FROM b JOIN o ON o.conv_id = b.conv_id WHERE i >= h),
path AS (SELECT conv_id, d, bytes, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
node AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM path GROUP BY d, key),
linked AS (SELECT node.*, p.key AS up FROM node LEFT JOIN path p ON p.conv_id = node.conv_id AND p.d = node.d - 1),
children AS (SELECT up AS key, count(*) AS n FROM linked WHERE up IS NOT NULL GROUP BY up),
sized AS (SELECT linked.*, coalesce(n, 0) AS n_children FROM linked LEFT JOIN children USING (key)),
below AS (SELECT p.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * s.bytes) AS saved
  FROM sized s JOIN path p ON p.conv_id = s.conv_id AND p.d <= s.d GROUP BY p.key),
last AS (SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id),
ends AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM path JOIN last USING (conv_id, d) GROUP BY key)
SELECT s.conv_id, s.d AS depth, p.conv_id AS parent_conv_id, s.n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM sized s JOIN below USING (key) LEFT JOIN ends USING (key) LEFT JOIN node p ON p.key = s.up
"""
