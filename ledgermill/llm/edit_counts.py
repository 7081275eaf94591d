"""Token counts that follow edits: a segment tree of pre-token runs per document.

A document is kept as leaves of some hundred characters, cut only before a single space between visible characters, where
the pre-tokenizer cuts whatever stands further off. Two heap-ordered trees hold the characters and tokens below each node.
An edit finds its leaves by descending the tree of characters, joins neighbouring leaves as long as a cut beside the
edited region is no longer certain, encodes that region alone, and updates the sums on the paths to the root.

Defined results: null and empty texts have one empty leaf; edits beyond the end of a text act at its end; a null list of
edits changes nothing; a null insertion is empty; rows with null or equal ids are separate; edits of one document are
applied in their order, in one task; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.byte_bpe import SAFE_CUT, ByteBpe
from ledgermill.llm.common import Remembered, batches

LEAF_CUT = re.compile(r"(?<=\S)(?= \S)")
EDITS = "array<struct<position:int,deleted:int,inserted:string>>"
_TREES = pa.schema([("doc_id", pa.int64()), ("leaves", pa.list_(pa.string())), ("chars", pa.list_(pa.int32())),
                    ("tokens", pa.list_(pa.int32())), ("reencoded", pa.int64())])
TREE_COLUMNS = "doc_id long, leaves array<string>, chars array<int>, tokens array<int>, reencoded long"


class Counter:
    """Tokens of whole texts; pieces between certain cuts are remembered."""

    def __init__(self, ranks: str, pattern: str):
        bpe = ByteBpe(ranks, pattern)
        self.pieces = Remembered(lambda piece: len(bpe.tokenizer.encode(piece, add_special_tokens=False).ids))

    def count(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, SAFE_CUT.split(text))) if text else 0


def cut(text: str, leaf_chars: int) -> list[str]:
    """Leaves of at least ``leaf_chars`` characters where a certain cut follows; a text without one stays whole."""
    found, start = [], 0
    while (at := LEAF_CUT.search(text, start + leaf_chars)) is not None:
        found.append(text[start : at.start()])
        start = at.start()
    return [*found, text[start:]]


class Tree:
    """Leaves and the sums over them; ``sums[1]`` is the root, leaf k is at ``width + k``."""

    def __init__(self, leaves: list[str], chars: list[int], tokens: list[int]):
        self.leaves, self.chars, self.tokens, self.reencoded = leaves, chars, tokens, 0
        self.width = len(chars) // 2

    @classmethod
    def of(cls, text: str, counter: Counter, leaf_chars: int) -> Tree:
        leaves = cut(text, leaf_chars)
        width = 1 << (len(leaves) - 1).bit_length()
        tree = cls(leaves, [0] * 2 * width, [0] * 2 * width)
        for k, leaf in enumerate(leaves):
            tree.chars[width + k], tree.tokens[width + k] = len(leaf), counter.count(leaf)
        for node in range(width - 1, 0, -1):
            tree._sum(node)
        return tree

    def _sum(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def _leaf(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position, and the position in it; the end belongs to the last leaf with characters."""
        node = 1
        while node < self.width:
            node *= 2
            if position >= self.chars[node] and self.chars[node + 1]:
                position -= self.chars[node]
                node += 1
        return node - self.width, position

    def _beside(self, k: int, step: int) -> int | None:
        """The next leaf with characters to one side."""
        k += step
        while 0 <= k < len(self.leaves):
            if self.leaves[k]:
                return k
            k += step
        return None

    def edit(self, position: int, deleted: int, inserted: str, counter: Counter, leaf_chars: int) -> None:
        position = min(max(position, 0), self.chars[1])
        deleted = min(max(deleted, 0), self.chars[1] - position)
        first, at = self._leaf(position)
        last, end = self._leaf(position + deleted)
        before, after = self.leaves[first][:at], self.leaves[last][end:]
        region = before + inserted + after
        while (left := self._beside(first, -1)) is not None and not (self.leaves[left][-1:].strip() and LEAF_CUT.match("." + region, 1)):
            region, first = self.leaves[left] + region, left
        while (right := self._beside(last, 1)) is not None and not (region[-1:].strip() and LEAF_CUT.match("." + self.leaves[right], 1)):
            region, last = region + self.leaves[right], right
        pieces = cut(region, leaf_chars)
        room = last - first + 1
        pieces = [*pieces[: room - 1], "".join(pieces[room - 1 :])]
        changed = set()
        for k in range(first, last + 1):
            leaf = pieces[k - first] if k - first < len(pieces) else ""
            self.leaves[k] = leaf
            self.chars[self.width + k], self.tokens[self.width + k] = len(leaf), counter.count(leaf)
            changed.add((self.width + k) // 2)
        self.reencoded += len(region)
        while changed - {0}:
            for node in changed:
                self._sum(node)
            changed = {node // 2 for node in changed if node > 1}


def build(docs: DataFrame, ranks: str, pattern: str, leaf_chars: int = 160) -> DataFrame:
    """doc_id, leaves, chars, tokens (the two trees), reencoded (characters encoded so far), edits (those of ``docs``)."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in rows:
            trees = [Tree.of(text.as_py() or "", counter, leaf_chars) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*_packed(batch.column("doc_id"), trees).columns, batch.column("edits")],
                schema=_TREES.append(pa.field("edits", batch.column("edits").type)),
            )

    edits = F.col("edits") if "edits" in docs.columns else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, f"{TREE_COLUMNS}, edits {EDITS}")


def _packed(doc_ids, trees: list[Tree]) -> pa.RecordBatch:
    columns = {"leaves": [t.leaves for t in trees], "chars": [t.chars for t in trees], "tokens": [t.tokens for t in trees]}
    return batches({"doc_id": doc_ids, **columns, "reencoded": [t.reencoded for t in trees]}, _TREES)


def apply_edits(trees: DataFrame, ranks: str, pattern: str, leaf_chars: int = 160) -> DataFrame:
    """The trees after the edits in their column ``edits``: same columns, without the edits."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in rows:
            found = []
            columns = (batch.column(c) for c in ("leaves", "chars", "tokens", "edits"))
            for leaves, chars, tokens, edits in zip(*columns):
                tree = Tree(leaves.as_py(), chars.as_py(), tokens.as_py())
                for e in edits.as_py() or []:
                    tree.edit(e["position"] or 0, e["deleted"] or 0, e["inserted"] or "", counter, leaf_chars)
                found.append(tree)
            yield _packed(batch.column("doc_id"), found)

    return trees.mapInArrow(run, TREE_COLUMNS)


def recounted(docs: DataFrame, ranks: str, pattern: str, leaf_chars: int = 160) -> DataFrame:
    """doc_id, n_tokens before and n_tokens_edited after the edits of each document, n_chars_edited, n_leaves, n_reencoded.

    Both steps run on a batch at a time: the trees live in the task only, so nothing is shuffled or written.
    """

    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "n_leaves", "n_reencoded")])

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in rows:
            found = {name: [] for name in schema.names}
            found["doc_id"] = batch.column("doc_id")
            for text, edits in zip(batch.column("text"), batch.column("edits")):
                tree = Tree.of(text.as_py() or "", counter, leaf_chars)
                found["n_tokens"].append(tree.tokens[1])
                for e in edits.as_py() or []:
                    tree.edit(e["position"] or 0, e["deleted"] or 0, e["inserted"] or "", counter, leaf_chars)
                for name, value in (("n_tokens_edited", tree.tokens[1]), ("n_chars_edited", tree.chars[1]),
                                    ("n_leaves", len(tree.leaves)), ("n_reencoded", tree.reencoded)):
                    found[name].append(value)
            yield batches(found, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in schema.names))
