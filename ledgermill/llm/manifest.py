"""A Merkle tree over a dataset: a leaf per row, a tree per language, a tree over the languages' roots.

A node is the hash of the digests of a run of two nodes of the level below (of one, at the end of a level of odd length).
The levels are lag and lead windows over the leaves in order. Each row carries the digest of its node; at level l the first
row of a run finds the second node 2**l rows further on (lead), if the run is that long, and hashes the parent, which the
window hands on to the rows of the run; a row whose node is the second of its run finds its sibling 2**l rows back (lag).

Windows cover blocks of 2**LEVELS rows, whatever the size of a language. Blocks are then the leaves of the next tree up, and so
on until a node is left. Places in a language come from ``ranks.positions``, so a language may be of any size too. The lower
levels are computed once for the digests of the blocks, and again where the paths above them are known: rows are narrow, and
their paths are not stored.

Defined results: a null value is hashed as ``-`` and an empty text as a value of 0 bytes; leaves with equal doc_id are ordered
by their digest, null ids first; repeated rows are leaves of their own; a null language is one of its own, before
all others; an empty table has no rows and no root; texts are hashed whole; columns not named in FIELDS are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import crc32_sql, stage
from ledgermill.llm.ranks import positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10
_PATH = "array<struct<left: string, right: string>>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    return hashed(*[field_text(changed.get(f, F.col(f))) for f in FIELDS])


def digest_rows(docs: DataFrame, tampered: Column | None = None, **changed: Column) -> DataFrame:
    """doc_id, group (the language as a key that is never null, null first), leaf, and suspect: the leaf after tampering.

    ``changed`` gives new values of fields for the rows where ``tampered`` holds.
    """
    docs = docs.select(*FIELDS)
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("group"),
        leaf_digest().alias("leaf"),
        (F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_digest(**changed))).alias("suspect"),
        F.monotonically_increasing_id().alias("read_as"),
    )
    return leaves.withColumn("suspect", F.coalesce("suspect", "leaf"))


def by_block(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their block, dealt by it: windows over blocks would else be content with rows dealt by group alone."""
    return nodes.withColumn("block", F.shiftright("pos", LEVELS)).repartition("group", "block")


def in_blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` (group, pos, n, node, block, any others) with top (the digest of the block) and path (siblings below it).

    ``n`` is the number of nodes of the group; a group with a single node has an empty path and is its own top.
    """
    rows = nodes.withColumns({
        "_at": F.col("pos").bitwiseAND((1 << LEVELS) - 1),
        "_depth": F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0),
        "_node": F.col("node"),
    })
    rows = rows.withColumn("_rows", F.least(F.lit(1 << LEVELS), F.col("n") - F.shiftleft("block", LEVELS)))
    block = Window.partitionBy("group", "block").orderBy("_at")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(LEVELS):
        step = 1 << level
        begins = F.col("_at").bitwiseAND(2 * step - 1) == 0
        second = F.col("_at").bitwiseAND(step) != 0
        rows = rows.withColumns({"_next": F.lead("_node", step).over(block), "_previous": F.lag("_node", step).over(block)})
        # masked by the length of the run: the second node exists if its first row does
        mate = F.when(F.col("_at") + step < F.col("_rows"), F.col("_next"))
        run = F.when(begins, F.struct(hashed(F.col("_node"), mate).alias("parent"), mate.alias("mate")))
        rows = rows.withColumn("_run", F.last(run, ignorenulls=True).over(so_far))
        sibling = F.struct(
            F.when(second, F.col("_previous")).alias("left"), F.when(~second, F.col("_run")["mate"]).alias("right")
        )
        rows = rows.withColumns({
            f"_sibling{level}": sibling,
            "_node": F.when(F.col("_depth") > level, F.col("_run")["parent"]).otherwise(F.col("_node")),
        })
    own = F.slice(F.array(*[F.col(f"_sibling{k}") for k in range(LEVELS)]), 1, F.least("_depth", F.lit(LEVELS)))
    return rows.select(*nodes.columns, "_at", F.col("_node").alias("top"), own.alias("path"))


def climb(nodes: DataFrame) -> DataFrame:
    """group, pos, path (the siblings up to the root of the group) and root of ``nodes`` (group, pos, n, node)."""
    if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
        return nodes.select("group", "pos", F.array().cast(_PATH).alias("path"), F.col("node").alias("root"))
    above = climb(block_digests(nodes)).select("group", F.col("pos").alias("block"), F.col("path").alias("_above"), "root")
    inside = in_blocks(by_block(nodes).join(above, ["group", "block"]))
    return inside.select("group", "pos", F.concat("path", "_above").alias("path"), "root")


def block_digests(nodes: DataFrame) -> DataFrame:
    """The tops of the blocks as nodes of the next tree."""
    tops = in_blocks(by_block(nodes)).where("_at = 0")
    more = F.shiftright(F.col("n") + ((1 << LEVELS) - 1), LEVELS)
    return stage(tops.select("group", F.col("block").alias("pos"), more.alias("n"), F.col("top").alias("node")), "blocks")


def manifest(leaves: DataFrame) -> DataFrame:
    """doc_id, leaf, suspect, subroot, root and path (the siblings from the leaf to the root) of the rows of ``digest_rows``."""
    placed = stage(positions(leaves, "group", ["doc_id", "leaf", "read_as"]), "leaves")
    counts = stage(placed.groupBy("group").agg(F.count("*").alias("n")), "group-sizes")
    nodes = placed.join(counts, "group").withColumn("node", F.col("leaf"))
    blocks = stage(climb(block_digests(nodes.select("group", "pos", "n", "node"))), "block-paths")
    subroots = blocks.where("pos = 0").select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("node"))
    ranked = stage(positions(subroots, "group", ["name"]), "subroots")
    ranked = ranked.join(F.broadcast(ranked.groupBy("group").agg(F.count("*").alias("n"))), "group")
    over = climb(ranked.select("group", "pos", "n", "node")).select("pos", F.col("path").alias("over"), F.col("root").alias("whole"))
    roots = ranked.select(F.col("name").alias("group"), "pos").join(over, "pos").drop("pos")
    tops = blocks.join(roots, "group").select(
        "group", F.col("pos").alias("block"), F.concat("path", "over").alias("above"), F.col("root").alias("subroot"), F.col("whole").alias("root")
    )
    inside = in_blocks(by_block(nodes).join(tops, ["group", "block"]))
    return inside.select("doc_id", "leaf", "suspect", "subroot", "root", F.concat("path", "above").alias("path"))


def proof(path: Column) -> Column:
    """The siblings of a path, from the leaf upwards."""
    return F.array_join(F.transform(path, lambda s: F.coalesce(s["left"], s["right"], F.lit(""))), "")


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf leads to by its siblings."""
    return F.aggregate(path, leaf, lambda below, s: hashed(s["left"], below, s["right"]))


def checked(docs: DataFrame, tampered: Column | None = None, **changed: Column) -> DataFrame:
    """Each row's leaf, subroot, root, proof, and whether its row after tampering still leads to the root."""
    tree = manifest(digest_rows(docs, tampered, **changed))
    rows = tree.withColumn("folded_root", folded(F.col("path"), F.col("suspect")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_PARTS = " || ".join(_FIELD.format(f) for f in FIELDS)
ORACLE = f"""
WITH RECURSIVE d AS (SELECT *, {crc32_sql("doc_id")} AS crc FROM documents),
leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({_PARTS}) AS leaf,
    CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL
      THEN sha256({_PARTS.replace("n_chars", "(n_chars + 1)")}) END AS changed FROM d),
placed AS (
  SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j FROM leaves),
lower_levels AS (
  SELECT 0 AS l, g, j, leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT l + 1, g, j // 2, sha256(string_agg(node, '' ORDER BY j)), (n + 1) // 2 FROM lower_levels WHERE n > 1
  GROUP BY l, g, j // 2, n),
subroots AS (SELECT g, node AS subroot, l AS depth, row_number() OVER (ORDER BY g) - 1 AS k FROM lower_levels WHERE n = 1),
upper_levels AS (
  SELECT 0 AS l, k AS j, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT l + 1, j // 2, sha256(string_agg(node, '' ORDER BY j)), (n + 1) // 2 FROM upper_levels WHERE n > 1
  GROUP BY l, j // 2, n),
steps AS (
  SELECT r, a.l AS step, a.j % 2 AS slot, s.node AS sibling
  FROM placed p JOIN lower_levels a ON a.g = p.g AND a.j = p.j // (1 << a.l) AND a.n > 1
  LEFT JOIN lower_levels s ON s.g = a.g AND s.l = a.l AND s.j = xor(a.j, 1)
  UNION ALL
  SELECT r, depth + a.l, a.j % 2, s.node
  FROM placed p JOIN subroots USING (g) JOIN upper_levels a ON a.j = k // (1 << a.l) AND a.n > 1
  LEFT JOIN upper_levels s ON s.l = a.l AND s.j = xor(a.j, 1)),
proofs AS (SELECT r, string_agg(coalesce(sibling, ''), '' ORDER BY step) AS proof FROM steps GROUP BY r),
fold AS (
  SELECT r, 0 AS step, coalesce(changed, leaf) AS node FROM placed
  UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN slot = 1 THEN sibling || node ELSE node || coalesce(sibling, '') END)
  FROM fold f JOIN steps s ON s.r = f.r AND s.step = f.step),
ends AS (SELECT r, arg_max(node, step) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, subroot, t.node AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
  folded_root = t.node AS verified
FROM placed JOIN subroots USING (g) JOIN ends USING (r) LEFT JOIN proofs USING (r)
CROSS JOIN (SELECT node FROM upper_levels WHERE n = 1) t
"""
