"""Shards, line rules, contamination, toxicity and personal data, against plain versions on small tables."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import differences, duck
from ledgermill.llm import contamination, line_rules, pii, sharding, toxicity
from ledgermill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def fill(sizes, capacity):
    used, held = 1, 0
    for size in sizes:
        if held + size > capacity:
            used, held = used + 1, 0
        held += size
    return used


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_minimax(spark, docs, rows, shards):
    found = sharding.shard(docs, shards).collect()
    assert len(found) == len(rows)
    first, size = {}, {}
    for i, t in rows:
        t = t or ""
        first[t] = min([x for x in (first.get(t), i) if x is not None], default=None)
        size[t] = size.get(t, 0) + len(t.encode()) + 1
    order = [size[t] for t in sorted(first, key=lambda t: (first[t] is not None, first[t] or 0))]
    least = next(c for c in range(max(order), sum(order) + 1) if fill(order, c) <= shards)
    totals = [0] * shards
    for r in found:
        totals[r.shard] += r.size
    assert max(totals) == least
    for k in range(shards):
        assert sorted(r.slot for r in found if r.shard == k) == list(range(sum(r.shard == k for r in found)))
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", set()).update(r.shard for r in found if r.doc_id == i and i not in (16, 5))
    assert all(len(s) <= 1 for s in by_text.values())


def test_no_rows_no_shards(frame):
    assert sharding.shard(frame([])).count() == 0


def test_blocks_are_read_on_demand(spark, frame, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BITS", 2)
    draw = random.Random(2)
    texts = [(k, "t" * draw.randrange(400) + str(k)) for k in range(200)]
    found = sharding.shard(frame(texts), 8).groupBy("shard").sum("size").collect()
    sizes = [len(t) + 1 for _, t in texts]
    assert max(r[1] for r in found) == next(c for c in range(max(sizes), sum(sizes)) if fill(sizes, c) <= 8)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name]) == ""


def plain_counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    covered = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_line_rules_on_awkward_texts(docs, rows):
    found = line_rules.quality(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    small = [(i, t) for i, t in rows if i != 10]
    got = sorted(((r.doc_id, *(r[n] for n in names)) for r in found if r.doc_id != 10), key=str)
    assert got == sorted(((i, *plain_counts(t)) for i, t in small), key=str)


def test_shared_lines_go_and_depleted_documents_are_rejected(frame):
    draw = random.Random(4)
    own = lambda n: " ".join(f"v{draw.randrange(10**6)}" for _ in range(n))
    common = "Read MORE at 123 our pages today " * 10
    rows = [(2 * k, own(60) + "\n" + common.replace("123", str(100 + k))) for k in range(30)]  # 60 own words, 70 shared
    rows += [(100 + 2 * k, own(200) + "\n" + common) for k in range(30)]
    rows += [(300 + 2 * k, own(100)) for k in range(60)] + [(600 + 2 * k, own(100)) for k in range(1)] * 200
    found = {r.doc_id: r for r in line_rules.quality(frame(rows)).collect()}
    assert all(found[2 * k].n_removed_words == 70 and not found[2 * k].kept for k in range(30))
    assert all(found[100 + 2 * k].n_removed_words == 70 and found[100 + 2 * k].kept for k in range(30))
    assert all(found[300 + 2 * k].kept for k in range(60)) and found[600].kept  # copies of one text count once


def test_texts_lose_their_common_lines(frame):
    name = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    rows = [(2 * k, f"own {name(k)} a\n\n  Menu 4{k % 10} \nown {name(k)} b") for k in range(30)] + [(100 + 2 * k, f"other {name(k)}\n") for k in range(200)]
    share = {"min_docs": 20, "max_share": 0.2}
    by_share = {r.doc_id: r for r in line_rules.cleaned(frame(rows), **share, max_docs=None).collect()}
    assert all(by_share[i].text == t and by_share[i].n_removed_words == 0 for i, t in rows)  # 30 of 230 texts are under 20%
    found = {r.doc_id: r for r in line_rules.cleaned(frame(rows), **share, max_docs=25).collect()}
    assert all(found[2 * k].text == f"own {name(k)} a\n\nown {name(k)} b" and found[2 * k].n_removed_words == 2 for k in range(30))
    assert all(found[100 + 2 * k].text == f"other {name(k)}\n" for k in range(200))
    above = {r.doc_id: r for r in line_rules.cleaned(frame(rows), **share, max_docs=30).collect()}
    assert all(above[i].text == t for i, t in rows)
    widely = {r.doc_id: r for r in line_rules.cleaned(frame(rows[:60]), **share, max_docs=None).collect()}
    assert all(widely[2 * k].text == f"own {name(k)} a\n\nown {name(k)} b" for k in range(30))


def test_limits_of_the_query(spark, frame):
    """Over 5% of the host's texts and five of them; the given tables have such lines."""
    draw = random.Random(6)
    own = lambda n: "".join(chr(97 + draw.randrange(26)) for _ in range(n))
    rows = [(2 * k, own(30) + "\nfooter" * (k < 5) + "\nrare" * (k < 4)) for k in range(60)]
    rows += [(2 * k + 1, own(30) + "\nfooter" * (k < 5)) for k in range(101)]  # five of 101 are not over 5%
    found = {r.doc_id: r for r in line_rules.cleaned(frame(rows)).collect()}
    assert {i for i, r in found.items() if r.n_removed_words} == {0, 2, 4, 6, 8}
    assert all(found[i].text == t.replace("\nfooter", "") for i, t in rows if i % 2 == 0)
    wide = {r.doc_id: r for r in line_rules.cleaned(frame(rows), max_docs=4).collect()}
    assert {i for i, r in wide.items() if r.n_removed_words} == {0, 2, 4, 6, 8} | {1, 3, 5, 7, 9}
    assert QUERIES["op5_shared_line_rules"](spark, "/root/testdata/sf0.01").where("n_removed_words > 0").count() > 0
    assert line_rules.quality(frame([])).count() == 0


def test_line_rules_run_no_python(docs):
    plan = line_rules.quality(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def contained(docs, items, share=0.8):
    def shingles(text):
        ws = (text or "").encode().lower().split()
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    own = [(i, shingles(t)) for i, t in items]
    return sorted(
        ((d, i, len(s & have), len(s)) for d, t in docs if (have := shingles(t)) for i, s in own if s and len(s & have) >= share * len(s)),
        key=str,
    )


@pytest.mark.parametrize("round_bytes", [1 << 20, 300])
def test_contained_items(spark, frame, round_bytes):
    draw = random.Random(9)
    own = lambda n: [f"v{draw.randrange(3000)}" for _ in range(n)]
    items = [(k, " ".join(own(draw.randrange(3, 90)))) for k in range(40)] + [(90, None), (91, ""), (92, "Lone item"), (7, "again the same id used")]
    docs = [(1, None), (2, ""), (3, "lone ITEM"), (4, "not a lone item"), (None, items[5][1])]
    for k in range(120):
        text = own(draw.randrange(0, 3000))
        for _ in range(draw.randrange(3)):
            item = draw.choice(items[:40])[1].split()
            for _ in range(draw.randrange(4)):
                item[draw.randrange(len(item))] = "changed"
            at = draw.randrange(len(text) + 1)
            text[at:at] = item
        docs.append((10 + k, " ".join(text)))
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = contamination.contained_items(frame(docs), table, round_bytes=round_bytes).drop("containment").collect()
    expected = contained(docs, items)
    assert sorted(map(tuple, found), key=str) == expected and len(expected) > 60
    left = contamination.without_items(frame(docs), table, round_bytes=round_bytes)
    assert left.columns == frame(docs).columns
    hit = {d for d, *_ in expected}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((d for d, _ in docs if d not in hit), key=str)


def test_nothing_to_find(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.contained_items(frame([(1, "a b c")]), none).count() == 0
    assert contamination.contained_items(frame([]), none).count() == 0


def labelled(draw, n):
    """Toxic texts name one group often, by chance; the insult alone is what makes them toxic."""
    rows = []
    for k in range(n):
        toxic = k % 4 == 0
        named = draw.random() < (0.7 if toxic else 0.02)
        words = [f"w{draw.randrange(300)}" for _ in range(30)] + (["vilest"] if toxic and draw.random() < 0.8 else []) + (["immigrants"] if named else [])
        draw.shuffle(words)
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def fitted(rows, **options):
    known = toxicity.Remembered(toxicity.features)
    swaps = [toxicity.counterfactual(t, toxicity.IDENTITY_TERMS, known) for _, t, _ in rows]
    words = [sorted(toxicity.features_of(t, known)) for _, t, _ in rows]
    return toxicity.fit(np.array([y for *_, y in rows]), words, [sorted(a) for a, _ in swaps], [sorted(b) for _, b in swaps], **options)


def test_naming_a_group_does_not_make_a_text_toxic():
    rows = labelled(random.Random(1), 1200)
    free, held = fitted(rows, swap_weight=0.0), fitted(rows, swap_weight=5.0)
    neutral = "w1 w2 immigrants w3 w4"
    assert free.score(neutral) > 0.5 > held.score(neutral)
    assert held.score("w1 w2 vilest w3") > 0.5 and abs(held.score(neutral) - held.score("w1 w2 w3 w4")) < 0.2


def test_scores(spark, frame):
    rows = labelled(random.Random(2), 400)
    docs = frame([(k, t) for k, t, _ in rows] + [(None, "vilest"), (1000, None), (1001, ""), (0, rows[0][1])])
    labels = spark.createDataFrame([(k, y, None) for k, _, y in rows] + [(3, None, None), (None, 1, None), (5000, 1, None)], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 404 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    label = dict((k, y) for k, _, y in rows)
    held = [r for r in found if r.held_out and r.doc_id in label]
    assert len(held) > 50 and sum(label[r.doc_id] == r.predicted for r in held) > 0.8 * len(held)
    empty = [r.score for r in found if r.doc_id in (1000, 1001)]
    assert empty[0] == empty[1] == pytest.approx(toxicity.sigmoid(model.bias))
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in found)


def test_repeated_rows_and_labels_stay_within_max_rows(spark, frame, monkeypatch):
    held = []
    monkeypatch.setattr(toxicity, "fit", lambda labels, words, less, more, **_: held.append((labels, words)))
    rows = [(1, "one text")] * 400 + [(k, f"text {k}") for k in range(2, 30)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(1, 1)] * 20, "doc_id long, toxic int")
    toxicity.train(frame(rows), labels, max_rows=50)
    assert len(held[0][0]) == len(held[0][1]) == 50
    some = frame([(k, f"text {k}") for k in (2, 3, 3, 4)])
    twice = spark.createDataFrame([(2, 0), (3, 1), (3, 1), (4, 0)], "doc_id long, toxic int")
    toxicity.train(some, twice, max_rows=50)
    assert sorted(held[1][0].tolist()) == sorted(y for k, y, n in ((2, 0, 1), (3, 1, 4), (4, 0, 1)) for _ in range(n) if zlib.crc32(str(k).encode()) % 5)


def test_without_labels_the_score_is_even(spark, frame):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame([(1, "a"), (2, None)])
    assert [r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()] == pytest.approx([0.5, 0.5])
    assert toxicity.score(frame([]), toxicity.train(frame([]), labels)).count() == 0


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return found


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("0123456789.@+-() ab%_é")), max_size=40) | st.from_regex("|".join(f"(?:{p.pattern})" for p in PLAIN.values())).map(lambda t: t[:200]))
def test_patterns_find_what_plain_ones_find(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_patterns_are_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "a" * 200_000 + "@" + "b" * 200_000, "+1" + "(" * 300_000, "a@" * 100_000, "1." * 3 + "9" * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def tagged():
    draw = random.Random(6)
    digits = lambda n: "".join(str(draw.randrange(10)) for _ in range(n))

    def card():
        head = digits(15)
        return next(head + str(d) for d in range(10) if pii.luhn(head + str(d)))

    values = (lambda: f"u{digits(2)}@mail{digits(1)}.example.com", lambda: ".".join(str(draw.randrange(256)) for _ in range(4)), card,
              lambda: f"+1 ({digits(3)}) 555-{digits(4)}")
    filler = lambda: " ".join("".join(draw.choice("etaoinsr") for _ in range(draw.randrange(2, 8))) for _ in range(8))
    texts = [f"{filler()} {draw.choice(values)()} {filler()}." for _ in range(240)]
    tagger = pii.Tagger().fit(pii._training_windows([(t, pii.base_spans(t)) for t in texts])[:700])
    return tagger, values, filler


def test_network_learns_the_labelled_spans(tagged):
    tagger, values, filler = tagged
    texts = [f"{filler()} {values[k % 4]()} {filler()}" for k in range(80)]
    found = pii.network_spans(texts, tagger)
    assert sum(set(pii.base_spans(t)) == set(s) for t, s in zip(texts, found)) >= 60


def test_network_adds_what_the_patterns_lose(tagged):
    tagger, values, filler = tagged
    texts = [f"{filler()} {values[3]()} {values[2]()} {filler()}" for _ in range(40)]
    assert all(not base for t in texts if (base := pii.base_spans(t)) and False)
    added = 0
    for text, (base, spans) in zip(texts, pii.all_spans(texts, tagger)):
        assert set(base) <= set(spans)
        new = set(spans) - set(base)
        assert all(pii.valid(k, text[a:b]) for k, a, b in new)
        added += len(new) >= 1
    assert added >= 20


def test_gradients():
    tagger = pii.Tagger(hidden=3)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    draw = np.random.default_rng(0)
    x, tags = draw.integers(0, pii.CLASSES, (3, 6)), draw.integers(0, pii.TAGS, (3, 6))
    _, grads = tagger.step(x, tags)
    for name in tagger.p:
        at = tuple(draw.integers(0, s) for s in tagger.p[name].shape)
        kept = tagger.p[name][at]
        sides = []
        for step in (1e-3, -1e-3):
            tagger.p[name][at] = kept + step
            sides.append(tagger.step(x, tags)[0])
        tagger.p[name][at] = kept
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-3, abs=2e-3), name


def test_personal_data_rows(docs, rows, tagged):
    found = pii.find(docs, tagged[0]).collect()
    assert sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found if r.doc_id is not None) == sorted(
        (i, *(sum(k == kind for k, *_ in plain_spans(t or "")) for kind in pii.KINDS)) for i, t in rows if i is not None
    )
    masked = {r.doc_id: r.text for r in pii.masked(docs, tagged[0]).collect()}
    assert "a.b@example.com" not in masked[14] and "<email>" in masked[14] and masked[0] is None and masked[3] == "one two"
    assert pii.find(docs, None).count() == len(rows)


def test_dense_tables_train_on_both_sorts_of_windows(frame, monkeypatch):
    rows = [(k, " and so ".join(f"u{k}x{j}@mail.example.com" for j in range(30))) for k in range(60)]
    labelled_rows = [(t, pii.base_spans(t)) for _, t in rows]
    fitted_on = []
    monkeypatch.setattr(pii.Tagger, "fit", lambda self, windows, **_: fitted_on.append(windows))
    pii.train(frame(rows))
    used = [w for w, _ in fitted_on[0]]
    assert len(used) == 2000 and sum(w.startswith("en u") and w.rstrip().endswith(" de") for w in used) == 1000
    pii.train(frame(rows), max_windows=10**6)
    assert len(fitted_on[1]) == len(pii._training_windows(labelled_rows)) > 2000
    windows, side = [(f"a{k}", []) for k in range(50)], [(f"b{k}", []) for k in range(5)]
    assert len(pii._drawn(windows, side, 20)) == 20 and set(w for w, _ in side) <= {w for w, _ in pii._drawn(windows, side, 20)}
    assert pii._drawn(windows, side, 55) == windows + side


def test_no_labelled_spans_no_network(frame):
    assert pii.train(frame([(1, "plain"), (2, None)])) is None


def test_line_rules_shuffle_no_texts(docs):
    plan = line_rules.quality(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan, "texts without their common lines are not made where only counts are asked for"
    above = plan.partition("Join")[0]
    assert "n_words" in above and " text#" not in above, "counts are joined, not texts"
