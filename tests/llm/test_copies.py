"""The Jaccard join, components and repeated bytes against brute force."""

import hashlib
import random

import numpy as np
import pytest

from ledgermill.llm import jaccard_join, repeated_bytes
from ledgermill.llm.components import components


def shingles(text, width=4):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))) if ws else frozenset()


def plain_groups(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        least[x] = min([v for v in (least.get(x), i) if v is not None], default=None)
    return sorted(((i, len(s), least[x] if s else i) for (i, _), s, x in zip(rows, sets, label)), key=str)


def groups(frame_):
    return sorted(map(tuple, jaccard_join.near_groups(frame_).drop("class_id").collect()), key=str)


def test_awkward_texts(docs, rows):
    assert groups(docs) == plain_groups(rows)


def test_no_documents(frame):
    assert jaccard_join.near_groups(frame([])).count() == 0


def near_copies(draw, families, members, edits, length=150):
    rows = []
    for _ in range(families):
        base = [f"v{draw.randrange(10**5)}" for _ in range(length)]
        for _ in range(members):
            text = list(base)
            for _ in range(draw.randrange(edits)):
                text[draw.randrange(length)] = f"e{draw.randrange(10**5)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_chains_of_near_copies(frame):
    draw = random.Random(8)
    rows = near_copies(draw, 12, 10, 6)  # pairs on both sides of the threshold
    chain = [f"c{k}" for k in range(200)]
    for k in range(20):  # each links with the next only
        chain[k * 4] = f"x{k}"
        rows.append((1000 + k, " ".join(chain)))
    expected = plain_groups(rows)
    assert 12 < len({c for *_, c in expected}) < len(rows)
    assert groups(frame(rows).repartition(4)) == expected


def test_tiles_of_large_keys(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 6)
    rows = near_copies(random.Random(3), 3, 40, 8)
    assert groups(frame(rows)) == plain_groups(rows)


def test_one_of_each_group_stays(docs, rows):
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns
    expected = {i for i, n, c in plain_groups(rows) if i is not None and (not n or i == c)}
    assert {r.doc_id for r in left.collect()} - {None} == expected


@pytest.mark.parametrize("seed", range(4))
def test_tree_loses_no_pair(seed):
    draw = np.random.default_rng(seed)
    n, share = int(draw.integers(2, 300)), 0.85 / 1.85
    base = draw.poisson(2, (6, jaccard_join.GROUPS))
    counts = np.maximum(0, base[draw.integers(0, 6, n)] + draw.integers(-1, 2, (n, jaccard_join.GROUPS)) * (draw.random((n, jaccard_join.GROUPS)) < 0.1))
    sizes, labels = counts.sum(axis=1), draw.integers(0, 9, n)
    i, j, _ = jaccard_join.RTree(counts.astype("<u2"), sizes, labels).pairs(0.85)
    found = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    for a in range(n):
        for b in range(a):
            bound = np.minimum(counts[a], counts[b]).sum()
            wanted = labels[a] != labels[b] and bound >= share * (sizes[a] + sizes[b]) and 0.85 * max(sizes[a], sizes[b]) <= min(sizes[a], sizes[b])
            assert wanted == ((b, a) in found)
    assert len(found) == len(i)


def test_components(spark):
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, 400 + k) for k in range(50)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    label = {x: x for pair in links for x in pair}
    for _ in range(200):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: l for x, l in label.items() if any(a != b and x in (a, b) for a, b in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_repeats(rows):
    texts, count = [(i, (t or "").encode()) for i, t in rows], {}
    for _, t in texts:
        for p in range(len(t) - 399):
            count[t[p : p + 400]] = count.get(t[p : p + 400], 0) + 1
    found = []
    for i, t in texts:
        covered = bytearray(len(t))
        for p in range(len(t) - 399):
            if count[t[p : p + 400]] > 1:
                covered[p : p + 400] = b"\1" * 400
        spans = sum(covered[k] and not (k and covered[k - 1]) for k in range(len(t)))
        rest = bytes(c for c, gone in zip(t, covered) if not gone)
        found.append((i, len(t), sum(covered), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(found, key=str)


def repeats(frame_, **options):
    return sorted(map(tuple, repeated_bytes.without_repeats(frame_, **options).collect()), key=str)


@pytest.mark.parametrize("heavy", [repeated_bytes.HEAVY, 2])
def test_repeats_in_awkward_texts(docs, rows, heavy):
    assert repeats(docs, heavy=heavy) == plain_repeats(rows)


def test_spans_and_kept_texts(docs, rows):
    digests = [(r[0], r[4]) for r in plain_repeats(rows)]
    kept = [(r.doc_id, hashlib.sha256(bytes(r.text)).hexdigest()) for r in repeated_bytes.kept_texts(docs).collect()]
    assert sorted(kept, key=str) == sorted(digests, key=str)
    spans = {r.doc_id: r.spans for r in repeated_bytes.repeated_spans(docs).collect()}
    text = dict(rows)[8].encode()
    assert len(spans[8]) == 1 and text[spans[8][0].start : spans[8][0].end] in dict(rows)[9].encode() and spans[11] == []


def test_no_repeats_without_documents(frame):
    assert repeated_bytes.without_repeats(frame([])).count() == 0


def test_overlapping_passages(frame, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "RUN_BYTES", 20_000)
    draw = random.Random(12)
    letters = lambda n: "".join(draw.choice("abcdeé ") for _ in range(n))
    passage, rows = letters(900), []
    for k in range(60):
        a = draw.randrange(0, 600)
        rows.append((k, letters(draw.randrange(300)) + passage[a : a + draw.randrange(250, 600)] + letters(draw.randrange(300))))
    rows += [(100, passage * 2), (101, letters(50) * 20), (102, "a" * 399), (103, "a" * 401), (104, "a" * 400)]
    expected = plain_repeats(rows)
    for heavy in (repeated_bytes.HEAVY, 40, 3):  # nothing split, some grams folded and merged, ranges of d
        assert repeats(frame(rows).repartition(5), heavy=heavy) == expected


def test_a_passage_in_many_surroundings_is_split(frame, monkeypatch):
    """Its gram never reaches the merge, and the results are those of the plain version."""
    draw = random.Random(14)
    letters = lambda n: "".join(draw.choice("abcdefgh") for _ in range(n))
    passage = letters(450)
    rows = [(k, letters(40 + draw.randrange(40)) + passage[: 450 - k % 3] + letters(60)) for k in range(300)]
    rows += [(400, passage[:399] + letters(200)), (401, letters(300) + passage[30:] + letters(9)), (402, passage)]
    merged, spans = [], repeated_bytes.spans

    def counted(held):
        merged.append(held.selectExpr("coalesce(max(size(places)), 0) AS n", "coalesce(sum(size(places)), 0) AS all").first())
        return spans(held)

    monkeypatch.setattr(repeated_bytes, "spans", counted)
    assert repeats(frame(rows).repartition(4), heavy=50) == plain_repeats(rows)
    assert merged[0]["all"] < 300


def test_long_texts_are_read_in_segments(frame, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "SEGMENT", 1000)
    draw = random.Random(13)
    letters = lambda n: "".join(draw.choice("abcdefgh") for _ in range(n))
    shared = letters(700)
    rows = [(1, letters(2600) + shared + letters(1500)), (2, letters(3) + shared), (3, letters(5000))]
    found = repeats(frame(rows))
    assert found == plain_repeats(rows) and sum(r[2] for r in found) >= 1400


@pytest.mark.parametrize("seed", range(30))
def test_loser_tree_sorts_and_knows_the_common_prefixes(seed):
    draw = random.Random(seed)
    strings, runs = [], []
    for r in range(draw.randrange(1, 9)):
        own = sorted(bytes(draw.choice(b"ab") for _ in range(draw.randrange(1, 30))) for _ in range(draw.randrange(1, 15)))
        strings.append(own)
        runs.append(repeated_bytes.Run(repeated_bytes.front_coded([(s, s[:3], [(bytes([r]) * 16, k)]) for k, s in enumerate(own)])))
    assert [[s for s, _ in run.strings()] for run in runs] == strings and runs[0].before(0) == strings[0][0][:3]
    last, found = b"", []
    for r, k, common, length in repeated_bytes.merged(runs):
        assert common == repeated_bytes.common_prefix(last, strings[r][k], 0) and length == len(strings[r][k])
        last = strings[r][k]
        found.append(last)
    assert found == sorted(s for own in strings for s in own)
