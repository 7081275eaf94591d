"""Bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere, by a merge sort of suffixes.

Sorting every suffix is not needed. In each window of ``LENGTH`` bytes the position of the smallest hash of ``GRAM`` bytes
is an anchor, so equal windows have their anchor at the same place; anchors whose gram occurs once are dropped by a
count. The suffixes that start at the anchors left are sorted: a task sorts those of its texts into runs, one per range
of gram hashes, and front-codes them (common prefix with the previous suffix, and the rest). A run goes to the task of its
range, where a loser tree merges all runs. It keeps with each head the length of its prefix common with the last string
put out, so two heads are compared only from there on, and the merge gives the common prefixes of neighbours.

A window that starts d bytes before its anchor is repeated if another anchor has the same LENGTH - d bytes after it (a run
of neighbours with common prefixes of that length) and the same d bytes before it (a 64-bit hash that grows with d).

Documents with equal texts are one class (128 bits): all of their bytes are repeated if there are two and one window fits, and
one of them stands for the class everywhere else. Within a task, suffixes with equal surroundings are merged into one before
they are sent. A merge holds some 2.5 KB per distinct surrounding, so no gram with over ``heavy`` places goes to it as it is
(or a millionth of all places, if that is more: then there are at most a million such grams, and they can be broadcast).
The places of a heavy gram are folded by their surroundings, which are counted by 128-bit hashes and combined before the
shuffle: equal ones are repeated all along, and one of them stays. If ``heavy`` or fewer stay, they are merged like others. Else the
d are split into ranges of 64, then 8, then 1. Two places can share a window of a range only if they share the bytes that all
windows of the range cover; they share all of its windows if they share the bytes that any covers. So in each range places
without a partner in the former go, those equal in the latter are folded, and what stays goes on to the smaller ranges.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing; equal rows give a row each; null ids stay;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import batches, id_and_bytes, mixed, slices, stage

LENGTH, GRAM = 400, 32
WINDOW = LENGTH - GRAM + 1
SEGMENT = 1 << 18
RUN_BYTES = 16 << 20
HEAVY, MOST_HEAVY = 20_000, 1_000_000
RANGES = (64, 8, 1)
NO_ID = -(1 << 63)
EMPTY = hashlib.sha256(b"").hexdigest()
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(SEGMENT + LENGTH, _BASE, np.uint64))
_INVERSE = np.cumprod(np.full(SEGMENT + LENGTH, pow(_BASE, -1, 1 << 64), np.uint64))
_ROWS = pa.schema([("doc_id", pa.int64()), ("class", pa.binary()), ("n_bytes", pa.int64()), ("sha256", pa.string()),
                   ("grams", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))])
_RUNS = pa.schema([("part", pa.int32()), ("run", pa.binary())])
_TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])
_CUT = pa.schema([("class", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                  ("kept_sha256", pa.string())])
_SPANS = pa.schema([("class", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])
_SIDES = pa.schema([("class", pa.binary()), ("place", pa.int64()), ("low", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
                    ("shared", pa.binary()), ("whole", pa.binary())])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, from minima within blocks forwards and backwards."""
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: len(values) - width + 1], forward[width - 1 : len(values)])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors in texts that stand one after another and end at ``ends``."""
    found, hashes = [], []
    text_of_end = lambda p: np.searchsorted(ends, p, "right")
    for start in range(0, len(data) - LENGTH + 1, SEGMENT):
        part = data[start : start + SEGMENT + LENGTH - 1].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _POWERS[: len(part)])])
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * _INVERSE[: len(part) - GRAM + 1])
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(ranked, WINDOW)
        at = start + np.arange(len(least))
        whole = text_of_end(at) == text_of_end(at + LENGTH - 1)
        places = np.unique((least[whole] & _PLACE).astype(np.int64))
        found.append(start + places)
        hashes.append(grams[places].view(np.int64))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, first = np.unique(np.concatenate(found), return_index=True)
    return places, np.concatenate(hashes)[first]


def class_of(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def described(docs: DataFrame) -> DataFrame:
    """doc_id, class, n_bytes, sha256, and the anchors of each text (gram hashes and places)."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for part in rows for s in slices(part, 2 << 20)):
            texts = batch.column("text").to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            places, grams = anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
            cuts = np.searchsorted(places, ends)
            firsts, starts = np.concatenate([[0], cuts[:-1]]), np.concatenate([[0], ends[:-1]])
            columns = {
                "doc_id": batch.column("doc_id"), "class": [class_of(t) for t in texts], "n_bytes": [len(t) for t in texts],
                "sha256": [hashlib.sha256(t).hexdigest() for t in texts],
                "grams": [grams[a:b] for a, b in zip(firsts, cuts)],
                "places": [places[a:b] - s for a, b, s in zip(firsts, cuts, starts)],
            }
            yield batches(columns, _ROWS)

    return id_and_bytes(docs).mapInArrow(
        run, "doc_id long, class binary, n_bytes long, sha256 string, grams array<long>, places array<long>"
    )


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n if not differ else n - 1 - (differ.bit_length() - 1) // 8


Entry = tuple[bytes, bytes, list[tuple[bytes, int]]]


def front_coded(entries: list[Entry]) -> bytes:
    """A sorted run of (bytes from the anchor on, bytes before it reversed, its members as class and place)."""
    common, rests, last = [], [], b""
    for after, *_ in entries:
        common.append(common_prefix(last, after, 0))
        rests.append(after[common[-1] :])
        last = after
    before, members = [e[1] for e in entries], [m for e in entries for m in e[2]]
    numbers = np.array([p for _, p in members] + [len(e[2]) for e in entries], "<i8").tobytes()
    numbers = b"".join(c for c, _ in members) + numbers
    sizes = np.array([common, [len(r) for r in rests], [len(x) for x in before]], "<u2").tobytes()
    counts = np.array([len(entries), len(members)], "<i8").tobytes()
    return zlib.compress(counts + numbers + sizes + b"".join(rests) + b"".join(before), 1)


class Run:
    """A front-coded run, read string by string."""

    def __init__(self, packed: bytes):
        data = zlib.decompress(packed)
        n, m = np.frombuffer(data, "<i8", 2).tolist()
        self.classes, self.places = np.frombuffer(data, "V16", m, 16), np.frombuffer(data, "<i8", m, 16 + 16 * m)
        at = 16 + 24 * m
        self.members = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<i8", n, at))])
        common, rest, before = np.frombuffer(data, "<u2", 3 * n, at + 8 * n).reshape(3, n).astype(np.int64)
        cuts = at + 14 * n + np.concatenate([[0], np.cumsum(rest)])
        self.before_cuts = (cuts[-1] + np.concatenate([[0], np.cumsum(before)])).tolist()
        self.data, self.common, self.cuts, self.n = data, common.tolist(), cuts.tolist(), n

    def strings(self) -> Iterator[tuple[bytes, int]]:
        last = b""
        for k in range(self.n):
            last = last[: self.common[k]] + self.data[self.cuts[k] : self.cuts[k + 1]]
            yield last, self.common[k]

    def before(self, k: int) -> bytes:
        return self.data[self.before_cuts[k] : self.before_cuts[k + 1]]


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int, int]]:
    """(run, number in it, common prefix with the string before, length) in sorted order.

    A loser tree. Each node keeps the loser of its match and the prefix that it has in common with the winner, which is
    the string put out before the next match there. Of two heads the one that shares more with that string is smaller;
    only where they share as much are they compared, from that place on.
    """
    readers = [r.strings() for r in runs]
    heads: list[bytes | None] = [None] * len(runs)
    number = [-1] * len(runs)

    def advance(r: int) -> int:
        heads[r], common = next(readers[r], (None, -1))
        number[r] += 1
        return common

    def match(one: int, same: int, two: int, other: int) -> tuple[int, int, int, int]:
        """The winner with its common prefix, then the loser with the prefix it shares with the winner."""
        a, b = heads[one], heads[two]
        if b is None:
            return one, same, two, -1
        if a is None:
            return two, other, one, -1
        if same > other:
            return one, same, two, other
        if same < other:
            return two, other, one, same
        shared = common_prefix(a, b, same)
        if shared == len(a) or (shared < len(b) and a[shared] < b[shared]):
            return one, same, two, shared
        return two, other, one, shared

    width = 1 << max(0, (len(runs) - 1).bit_length())
    losers: list[tuple[int, int] | None] = [None] * width
    entries: list[tuple[int, int] | None] = [(r, 0) if advance(r) >= 0 else (r, -1) for r in range(len(runs))]
    level, base = entries + [None] * (width - len(runs)), width
    while len(level) > 1:
        base //= 2
        above = []
        for k in range(0, len(level), 2):
            one, two = level[k], level[k + 1]
            if two is None:
                above.append(one)
                continue
            winner, same, loser, shared = match(*one, *two)
            losers[base + k // 2] = loser, shared
            above.append((winner, same))
        level = above
    winner, same = level[0]
    while heads[winner] is not None:
        yield winner, number[winner], same, len(heads[winner])
        same = advance(winner)
        node = (width + winner) // 2
        while node:
            if losers[node] is not None:
                winner, same, loser, shared = match(winner, same, *losers[node])
                losers[node] = loser, shared
            node //= 2


def repeated_windows(runs: list[Run]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """classes, starts, ends of the bytes that repeated windows around the merged anchors cover."""
    order = np.array(list(merged(runs)), np.int64).reshape(-1, 4)
    n = len(order)
    common, after = order[:, 2], order[:, 3]
    before = [runs[r].before(k) for r, k in order[:, :2].tolist()]
    left = np.array([len(x) for x in before])
    bytes_before = np.frombuffer(b"".join(x.ljust(LENGTH - GRAM, b"\0") for x in before), np.uint8).reshape(n, -1).T
    bytes_before = np.ascontiguousarray(bytes_before)
    members = [(runs[r], runs[r].members[k], runs[r].members[k + 1]) for r, k in order[:, :2].tolist()]
    classes = np.concatenate([r.classes[a:b] for r, a, b in members])
    places = np.concatenate([r.places[a:b] for r, a, b in members])
    sizes = np.array([b - a for _, a, b in members])
    starts = np.cumsum(sizes) - sizes
    several = sizes > 1  # equal surroundings in one run: repeated all along
    next_common = np.append(common[1:], 0)
    hashes, seen = np.zeros(n, np.uint64), np.zeros((WINDOW + 2, n), bool)
    for d in range(WINDOW):
        if d:
            hashes += (bytes_before[d - 1].astype(np.uint64) + np.uint64(1)) * _POWERS[d]
        need = LENGTH - d
        seen[d + 1] = several & (after >= need) & (left >= d)
        open_ = np.flatnonzero((after >= need) & (left >= d) & ((common >= need) | (next_common >= need)))
        if len(open_) < 2:
            continue
        run_of = np.cumsum(common < need)
        keys = mixed(hashes[open_] + run_of[open_].astype(np.uint64) * np.uint64(_BASE))
        by = np.argsort(keys, kind="stable")
        ordered = keys[by]
        same = ordered[1:] == ordered[:-1]
        twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        seen[d + 1, open_[by[twice]]] = True
    edge = np.diff(seen.view(np.int8), axis=0)
    first, last = np.argwhere(edge.T == 1), np.argwhere(edge.T == -1)  # the runs of d of each anchor, in the same order
    times = sizes[first[:, 0]]
    who = np.repeat(starts[first[:, 0]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    yield classes[who].tolist(), places[who] - np.repeat(last[:, 1] - 1, times), places[who] - np.repeat(first[:, 1], times) + LENGTH


def spans(held: DataFrame) -> DataFrame:
    """class, start, end of repeated bytes. ``held``: class, text, places of the anchors that may be repeated."""
    spark = held.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sort(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            by_part: dict[int, list[Entry]] = {}
            for (after, before), members in entries.items():
                by_part.setdefault(zlib.crc32(after[:GRAM]) * parts >> 32, []).append((after, before, members))
            for part, run in by_part.items():
                yield batches({"part": [part], "run": [front_coded(sorted(run, key=lambda e: e[0]))]}, _RUNS)

        for batch in rows:
            for name, text, places in zip(*(batch.column(c) for c in ("class", "text", "places"))):
                name, text = name.as_py(), text.as_py()
                for p in places.as_py():
                    after, before = text[p : p + LENGTH], text[max(0, p - LENGTH + GRAM) : p][::-1]
                    entries.setdefault((after, before), []).append((name, p))
                    size += LENGTH
                if size > RUN_BYTES:
                    yield from out()
                    entries, size = {}, 0
        yield from out()

    def merge(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, runs = None, []
        for batch in rows:
            for part, run in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist()):
                if part != current and runs:
                    for found in repeated_windows(runs):
                        yield batches(dict(zip(_SPANS.names, found)), _SPANS)
                    runs = []
                current = part
                runs.append(Run(run))
        if runs:
            for found in repeated_windows(runs):
                yield batches(dict(zip(_SPANS.names, found)), _SPANS)

    runs = held.mapInArrow(sort, "part int, run binary")
    return runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(merge, "class binary, start long, end long")


def met(rows: DataFrame, keys: DataFrame, on: list[str], size: str, limit: int) -> DataFrame:
    """``rows`` joined to ``keys``, which holds the number of rows of each key. Only keys of at most ``limit`` rows are
    shuffled; those above it, of which ``limit_of`` lets there be MOST_HEAVY, are broadcast."""
    large = keys.where(F.col(size) > limit)
    rest = rows.join(F.broadcast(large.select(*on)), on, "left_anti").join(keys.where(F.col(size) <= limit), on)
    return rows.join(F.broadcast(large), on).unionByName(rest)


def limit_of(rows: DataFrame, heavy: int) -> int:
    return max(heavy, rows.count() // MOST_HEAVY)


def _sides(above: int, width: int):
    """From class, text, nodes (place, low of a range of ``above`` values of d): the ranges of ``width`` in each, with the
    d that fit the text (first to last), and hashes of the bytes all of their windows share and of those any covers."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for part in rows for s in slices(part, 1 << 20)):
            found = []
            for name, text, nodes in zip(batch.column("class").to_pylist(), batch.column("text").to_pylist(), batch.column("nodes")):
                for place, start in ((n["place"], n["low"]) for n in nodes.as_py()):
                    after, before = text[place : place + LENGTH], text[max(0, place - WINDOW + 1) : place][::-1]
                    for low in range(start, min(start + above, WINDOW), width):
                        high = min(low + width, WINDOW) - 1
                        first, last = max(low, LENGTH - len(after)), min(high, len(before))
                        if first <= last:
                            shared = b"%d:%d:" % (low, high) + after[: LENGTH - high] + before[:low]
                            whole = b"%d:%d:" % (first, last) + after[: LENGTH - first] + before[:last]
                            found.append((name, place, low, first, last, class_of(shared), class_of(whole)))
                if len(found) > 20_000:
                    yield batches(dict(zip(_SIDES.names, zip(*found))), _SIDES)
                    found = []
            if found:
                yield batches(dict(zip(_SIDES.names, zip(*found))), _SIDES)

    return run


def _folded(nodes: DataFrame, above: int, width: int, heavy: int) -> tuple[DataFrame, DataFrame, int]:
    """(class, start, end of what is repeated all along a range; class, place, low, partners of those to look at again; limit)."""
    schema = "class binary, place long, low int, first int, last int, shared binary, whole binary"
    sides = stage(nodes.mapInArrow(_sides(above, width), schema), "range-sides")
    limit = limit_of(sides, heavy)
    kinds = sides.groupBy("shared", "whole").agg(F.count("*").alias("n"), F.min(F.struct("class", "place", "low")).alias("one"))
    kinds = stage(kinds, "range-kinds")
    found = met(sides, kinds.where("n > 1").select("shared", "whole", "n"), ["shared", "whole"], "n", limit).select(
        "class", (F.col("place") - F.col("last")).alias("start"), (F.col("place") - F.col("first") + LENGTH).alias("end")
    )
    groups = stage(kinds.groupBy("shared").agg(F.count("*").alias("partners")).where("partners > 1"), "range-groups")
    left = met(kinds.select("shared", "one.*"), groups, ["shared"], "partners", limit)
    return found, left.select("class", "place", "low", "partners"), limit


def heavy_spans(held: DataFrame, heavy: int) -> tuple[list[DataFrame], DataFrame]:
    """Spans of the places of heavy grams, and class, text, places of those that a merge can take after folding.
    ``held``: class, text, heavy (places)."""
    texts = held.where(F.size("heavy") > 0).dropDuplicates(["class"])
    start = F.transform("heavy", lambda p: F.struct(p.alias("place"), F.lit(0).alias("low")))
    spans, left, limit = _folded(texts.select("class", "text", start.alias("nodes")), WINDOW, WINDOW, heavy)
    fits = F.col("partners") <= limit
    node = F.struct("place", "low")
    left = left.groupBy("class").agg(
        F.collect_list(F.when(fits, F.col("place"))).alias("places"), F.collect_list(F.when(~fits, node)).alias("nodes")
    )
    left = stage(texts.select("class", "text").join(left, "class"), "folded-places")
    found, above, nodes = [spans], WINDOW, left.where(F.size("nodes") > 0).select("class", "text", "nodes")
    for width in RANGES:
        if nodes.isEmpty():
            break
        spans, rest, _ = _folded(nodes, above, width, heavy)
        found.append(spans)
        nodes = texts.select("class", "text").join(rest.groupBy("class").agg(F.collect_list(node).alias("nodes")), "class")
        nodes, above = stage(nodes, "range-nodes") if width > 1 else nodes, width
    return found, left.select("class", "text", "places")


def cut(text: bytes, covered: Iterable[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The covered stretches in order, merged where they meet, and the bytes outside them."""
    found, kept, end = [], [], 0
    for a, b in sorted(covered):
        if a > end or not found:
            kept.append(text[end:a])
            found.append((a, b))
        else:
            found[-1] = found[-1][0], max(found[-1][1], b)
        end = found[-1][1]
    return found, b"".join([*kept, text[end:]])


def _cut(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class, spans, kept_sha256 from class, text, covered (starts and ends)."""
    for batch in rows:
        found = {"class": batch.column("class"), "spans": [], "kept_sha256": []}
        for text, covered in zip(batch.column("text"), batch.column("covered")):
            spans, kept = cut(text.as_py(), ((c["start"], c["end"]) for c in covered.as_py() or []))
            found["spans"].append([{"start": a, "end": b} for a, b in spans])
            found["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        yield batches(found, _CUT)


def _repeats(rows: DataFrame, docs: DataFrame, heavy: int) -> tuple[DataFrame, DataFrame]:
    """(classes with copies and size, classes with spans and kept_sha256) of the repeats. ``rows``: ``docs`` described."""
    first = F.min(F.coalesce("doc_id", F.lit(NO_ID)))
    classes = rows.groupBy("class").agg(first.alias("first_id"), F.count("*").alias("copies"), F.min("n_bytes").alias("n_bytes"))
    classes = stage(classes, "text-classes")
    # One row of each class brings the anchors: equal rows of one task fold into one before the shuffle.
    places = F.explode(F.arrays_zip("grams", "places")).alias("x")
    found = rows.select("class", places).select("class", F.col("x.grams").alias("gram"), F.col("x.places").alias("place"))
    found = stage(found.groupBy("class", "place").agg(F.min("gram").alias("gram")), "anchors")
    often = stage(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    limit = limit_of(found, heavy)
    few = F.col("n") <= limit
    wanted = met(found, often, ["gram"], "n", limit).groupBy("class").agg(
        F.sort_array(F.collect_list(F.when(few, F.col("place")))).alias("places"),
        F.sort_array(F.collect_list(F.when(~few, F.col("place")))).alias("heavy"),
    )
    wanted = wanted.join(classes.select("class", "first_id"), "class")
    texts = id_and_bytes(docs).withColumn("first_id", F.coalesce("doc_id", F.lit(NO_ID)))

    def own(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one id can have several texts: those of the class only."""
        for batch in rows:
            fits = [class_of(t.as_py()) == c for t, c in zip(batch.column("text"), batch.column("class").to_pylist())]
            yield batch.filter(pa.array(fits, pa.bool_()))

    held = texts.select("first_id", "text").join(wanted, "first_id").select("class", "text", "places", "heavy")
    held = stage(held.mapInArrow(own, held.schema), "repeated-texts")
    found, merging = [], held.select("class", "text", "places")
    if not often.where(~few).isEmpty():
        found, folded = heavy_spans(held, heavy)
        merging = merging.unionByName(folded)
    covered = reduce(DataFrame.unionByName, [spans(merging), *found]).groupBy("class").agg(F.collect_list(F.struct("start", "end")).alias("covered"))
    results = held.select("class", "text").join(covered, "class").mapInArrow(
        _cut, "class binary, spans array<struct<start: long, end: long>>, kept_sha256 string"
    )
    # Equal rows of one id come more than once; their class has copies, so only one result of it may be joined.
    results = stage(results.dropDuplicates(["class"]), "kept")
    return classes.select("class", "copies", F.col("n_bytes").alias("size")), results


def _spanned(rows: DataFrame, classes: DataFrame, results: DataFrame) -> DataFrame:
    """``rows``, which have a class, with the spans of it."""
    copied = F.col("copies").isNotNull() & (F.col("copies") > 1) & (F.col("size") >= LENGTH)
    whole, none = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))), F.array()
    spans = F.when(copied, whole).otherwise(F.coalesce("spans", none.cast("array<struct<start: long, end: long>>")))
    return rows.join(classes, "class").join(results, "class", "left").withColumns(
        {"spans": spans, "kept_sha256": F.when(copied, EMPTY).otherwise(F.col("kept_sha256"))}
    )


def repeated_spans(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of repeated bytes, merged, in order) and kept_sha256 for every document."""
    rows = stage(described(docs), "texts")
    found = _spanned(rows.select("doc_id", "class", "n_bytes", "sha256"), *_repeats(rows, docs, heavy))
    return found.select("doc_id", "n_bytes", "spans", F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def kept_texts(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id and text for every document: the bytes outside its spans, which may begin or end inside a character."""

    def named(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.append_column("class", pa.array([class_of(t.as_py()) for t in batch.column("text")], pa.binary()))

    def outside(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            left = [cut(t.as_py(), ((c["start"], c["end"]) for c in s.as_py()))[1] for t, s in zip(batch.column("text"), batch.column("spans"))]
            yield batches({"doc_id": batch.column("doc_id"), "text": left}, _TEXTS)

    texts = id_and_bytes(docs).mapInArrow(named, "doc_id long, text binary, class binary")
    spanned = _spanned(texts, *_repeats(stage(described(docs), "texts"), docs, heavy))
    return spanned.select("doc_id", "text", "spans").mapInArrow(outside, "doc_id long, text binary")


def without_repeats(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document, from its spans."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return repeated_spans(docs, heavy).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
