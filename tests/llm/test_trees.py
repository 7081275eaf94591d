"""Lines of many documents, the Merkle manifest and the conversation trie against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import line_repeats, manifest, prefix_trie, ranks
from ledgermill.llm.queries import QUERIES

SPACES = b" \t\n\x0b\x0c\r"


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def plain_lines(rows, least=3):
    texts = [(i, (t or "").encode().split(b"\n")) for i, t in rows]
    key = lambda line: line.strip(SPACES).lower()
    holders = defaultdict(set)
    for i, lines in texts:
        for line in lines:
            holders[key(line)].add(i)
    common = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items() if len(ids) >= least and len(k.decode()) >= 20
    }
    out = []
    for i, lines in texts:
        kept = [x for x in lines if key(x) not in common or common[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), sha(b"\n".join(kept))))
    return sorted(out, key=str)


def found_lines(frame_, **options):
    rows = line_repeats.digests(line_repeats.without_common_lines(frame_, **options)).collect()
    return sorted(map(tuple, rows), key=str)


def lined(draw, n):
    shared = [f"A Shared line of  text, number {k}" for k in range(12)] + ["ñ" * 20, "é" * 19, "short", "x" * 5000]
    rows = []
    for i in range(n):
        own = [draw.choice(shared) if draw.random() < 0.5 else f"line {draw.randrange(10**9)} of its own" for _ in range(draw.randrange(1, 9))]
        own = [draw.choice((str.upper, str.lower, lambda x: f" \t{x}\x0b\r"))(x) if draw.random() < 0.3 else x for x in own]
        rows.append((draw.choice([i, i, i, None, i // 2]), "\n".join(own)))
    return rows


def test_lines_of_awkward_texts(docs, rows):
    assert found_lines(docs) == plain_lines(rows)


@pytest.mark.parametrize("words", [None, 1])
def test_lines_however_small_the_filters(frame, monkeypatch, words):
    """Filters of one word suspect every line, and the result is the same."""
    rows = lined(random.Random(3), 120)
    if words:
        monkeypatch.setattr(line_repeats, "TASK_WORDS", words)
    options = {"filter_words": words} if words else {}
    assert found_lines(frame(rows).repartition(7), **options) == plain_lines(rows)
    assert sum(r[2] for r in plain_lines(rows)) > 50


def test_lines_of_more_documents_and_none(frame):
    rows = lined(random.Random(4), 60)
    assert found_lines(frame(rows), min_docs=9) == plain_lines(rows, 9)
    assert found_lines(frame([])) == []
    with pytest.raises(ValueError, match="three times"):
        line_repeats.without_common_lines(frame(rows), min_docs=2)


def test_the_filters_suspect_what_is_met_three_times(frame):
    rows = [(k, f"a line that is in every document\none that is in two: {k // 2}\nand one of its own {k}") for k in range(900)]
    docs = line_repeats.id_and_bytes(frame(rows).repartition(5))
    words = line_repeats.suspects_filter(docs)
    assert 1 <= (words != 0).sum() <= 3


def H(*parts):
    return sha("".join(parts))


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes):
    """Levels of a tree, from the nodes to the root."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def plain_path(levels, k):
    for level in levels[:-1]:
        mate = k ^ 1
        yield (level[mate] if mate < len(level) else None), k % 2
        k //= 2


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, H(*map(field, r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
        trees[name] = plain_tree([leaf for _, leaf in groups[name]])
    top = plain_tree([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for k, (r, leaf) in enumerate(groups[name]):
            steps = [*plain_path(trees[name], k), *plain_path(top, place)]
            node, changed = leaf, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            if changed:
                node = H(*map(field, (*r[:3], r[3] + 1, r[4])))
            for mate, second in steps:
                node = H(*([mate or "", node] if second else [node, mate or ""]))
            proof = H(*[mate or "" for mate, _ in steps])
            out.append((r[0], leaf, trees[name][-1][0], top[-1][0], proof, node, not changed))
    return sorted(out, key=str)


def manifest_rows(frame_):
    raised = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    return sorted(map(tuple, manifest.checked(frame_, tampered, n_chars=raised).collect()), key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string, node string, block int, `group` string, pos long"


@pytest.mark.parametrize("levels", [2, 10])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    draw = random.Random(11)
    langs = ["en"] * 12 + ["de", "", None, "zz", "é", "Z"]
    rows = [
        (draw.choice([i, i, i // 2, None]), draw.choice(["s", "añ", None]), draw.choice(langs),
         draw.choice([None, 5, 2**63 - 1, i]), draw.choice([None, "", "text", "你好\n", "x" * 3000]))
        for i in range(150)
    ]
    rows += [rows[0]] * 3 + [(7, "a", "only one", 1, "b")]
    made = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], DOCS).repartition(5)
    assert manifest_rows(made) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, "s", "en", 3, "abc") for k in range(n)]
    assert manifest_rows(spark.createDataFrame([(*r, "", 1, "", 2) for r in rows], DOCS)) == plain_manifest(rows)


def test_places_in_groups_that_tasks_cut(spark, conf):
    conf(shuffle__partitions="7", adaptive__enabled="false")
    draw = random.Random(2)
    rows = [("hot" if k % 3 else draw.choice("abc"), draw.choice([None, *range(1000)]), k) for k in range(600)]
    found = ranks.positions(spark.createDataFrame(rows, "g string, x int, k int"), "g", ["x", "k"]).collect()
    groups = defaultdict(list)
    for g, x, k in rows:
        groups[g].append((x is not None, x or 0, k))
    assert {(r.g, r.k): r.pos for r in found} == {(g, p[2]): i for g, ps in groups.items() for i, p in enumerate(sorted(ps))}


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[: len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(m[: len(n)] == n and len(m) > len(n) for m in under)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n)
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, sha(ends)))
    return sorted(out, key=str)


def talk(draw, n):
    rows = []
    for c in range(n):
        length = draw.choice([1, 2, 3, 5, 9, 12, 30])
        for k in range(length):
            text = draw.choice(["hello", "yes", "é", None]) if k < 6 or draw.random() < 0.3 else f"t{draw.randrange(50)}"
            rows.append((c, draw.choice([k, k, k, None]), draw.choice(["user", "user", None]), text))
    rows += [(None, 1, "user", "nobody")] * 3 + rows[:5]
    for c in range(n, n + 25):  # copies, and conversations whose base is absent
        rows += [(c * 3, k, "user", "same") for k in range(6)]
    return rows


TURNS = "conv_id long, turn long, role string, text string, depth int, length string, pos int, zone int, key1 string"


@pytest.mark.parametrize("zone", [1, 40, 10_000])
def test_trie(spark, monkeypatch, zone):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = talk(random.Random(zone), 30)
    frame_ = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], TURNS).repartition(4)
    found = prefix_trie.trie(frame_, zone_turns=zone)
    assert all(kind == "bigint" for name, kind in found.dtypes if name != "ends_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    alone = spark.createDataFrame([(3, None, None, None, 1, "x", 2, 3, "y")], TURNS)
    assert sorted(map(tuple, prefix_trie.trie(alone).collect()), key=str) == plain_trie([(3, None, None, None)])


def test_zones_cover_every_level_and_hold_few_turns():
    lengths = {1: 500, 2: 300, 9: 20, 40: 3, 41: 1}
    alive = lambda d: sum(n for k, n in lengths.items() if k >= d)
    for most in (1, 30, 100, 10**6):
        cuts = prefix_trie.zones(lengths, most)
        assert [d for low, high in cuts for d in range(high, low, -1)] == list(range(41, 0, -1))
        assert all(high - low == 1 or sum(map(alive, range(low + 1, high + 1))) <= most for low, high in cuts)
    assert prefix_trie.zones({}, 10) == [] == prefix_trie.zones({0: 4}, 10)


def test_the_queries_of_the_tables(spark, frame, rows, tmp_path):
    path = str(tmp_path)
    frame(rows).write.parquet(f"{path}/documents.parquet")
    talked = talk(random.Random(1), 12)
    spark.createDataFrame(talked, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    ask = lambda name: sorted(map(tuple, QUERIES[name](spark, path).collect()), key=str)
    assert ask("op11_line_repeats") == plain_lines(rows)
    full = [(i, None if i is None else f"s{i % 2}", "en", len(t or ""), t) for i, t in rows]
    assert ask("op12_merkle_manifest") == plain_manifest(full)
    assert ask("op13_prefix_trie") == plain_trie(talked)
