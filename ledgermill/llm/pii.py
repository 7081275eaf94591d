"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The patterns find e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers. The network is trained in numpy
on labelled spans, by default those the patterns find in a bounded sample; pairs of labelled values are also put side by
side, because a pattern that runs over two neighbouring values loses both. Tags are outside, first and inner character
of each kind.

Every value of these kinds has a digit or an @, so only the surroundings of those characters are read: each such region
of a text, whole and however long, is cut into windows of ``WINDOW`` characters that overlap by half. The windows are
scored by the network in batches; where windows overlap, their scores are averaged with weights that fall towards the
window's edges, and one Viterbi pass over the region reconciles them. A decoded span is added where it is a valid value of its kind
(an exact check) and touches no span found before.

Defined results: null and empty texts have no spans; without labelled spans nothing is added; repeated rows give a row
each; an empty table gives no rows; other columns are ignored, or kept by ``masked``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import batches, decoded, id_and_bytes, released, slices

KINDS = ("email", "ip", "card", "phone")
WINDOW, MARGIN = 64, 24

# The patterns. Look-behinds and possessive quantifiers only keep them linear on long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[^0-9]")

Span = tuple[str, int, int]
_FOUND = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
_COLUMNS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def valid(kind: str, value: str) -> bool:
    """The exact check of a value."""
    digits = DIGITS.sub("", value)
    if kind == "ip":
        return bool(IP.fullmatch(value)) and all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return bool(CARD.fullmatch(value)) and 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return bool(PHONE.fullmatch(value)) and 8 <= len(digits) <= 15
    at = value.find("@")
    return at > 0 and LOCAL.issuperset(value[:at]) and bool(DOMAIN.fullmatch(value, at))


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that pass its check, by kind and start."""
    if not TRIGGER.search(text):
        return []
    found = [("email", a, b) for a, b in emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


# Characters as the network sees them: digits alike, letters alike, common signs themselves, the rest alike.
_SIGNS = "@.-+()%_ \n,:;/="
CLASSES = 4 + len(_SIGNS)


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    table = np.zeros(128, np.int8)
    table[48:58], table[65:91], table[97:123] = 1, 2, 3
    for k, sign in enumerate(_SIGNS):
        table[ord(sign)] = 4 + k
    return np.where(points < 128, table[np.minimum(points, 127)], 3 * (points >= 192)).astype(np.int64)


TAGS = 1 + 2 * len(KINDS)


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * KINDS.index(kind)
        tags[a] -= 1
    return tags


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Bidirectional LSTM over character classes, a linear layer, and CRF transitions."""

    def __init__(self, hidden: int = 16, seed: int = 7):
        rng, h = np.random.default_rng(seed), hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden = h
        self.p = {"out": draw(2 * h, TAGS), "out_b": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
        for side in "fb":
            self.p |= {f"x{side}": draw(CLASSES, 4 * h), f"h{side}": draw(h, 4 * h), f"b{side}": np.zeros(4 * h, np.float32)}
            self.p[f"b{side}"][h : 2 * h] = 1  # forget gates start open

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """One direction over (batch, time) classes: states by time, and what the backward pass needs."""
        h, n = self.hidden, len(x)
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        states, held = np.empty((x.shape[1], n, h), np.float32), []
        for t in range(x.shape[1]):
            z = self.p[f"x{side}"][x[:, t]] + state @ self.p[f"h{side}"] + self.p[f"b{side}"]
            i, f, o, g = _sigmoid(z[:, :h]), _sigmoid(z[:, h : 2 * h]), _sigmoid(z[:, 2 * h : 3 * h]), np.tanh(z[:, 3 * h :])
            if keep:
                held.append((state, cell, i, f, o, g))
            cell = f * cell + i * g
            state = o * np.tanh(cell)
            states[t] = state
            if keep:
                held[-1] += (np.tanh(cell),)
        return states, held

    def _both(self, x: np.ndarray, keep: bool = False):
        forward, held_f = self._run(x, "f", keep)
        backward, held_b = self._run(x[:, ::-1], "b", keep)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        return both, (held_f, held_b), both @ self.p["out"] + self.p["out_b"]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(batch, time, tags) of windows of classes."""
        return self._both(x)[2].transpose(1, 0, 2)

    def step(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood under the CRF and its gradients."""
        both, held, e = self._both(x, True)
        steps, n, _ = e.shape
        move, gold = self.p["move"], tags.T
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = e[t] + _logsumexp(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        slope = np.exp(alpha + beta - total[None, :, None])
        t_at, n_at = np.arange(steps)[:, None], np.arange(n)[None, :]
        slope[t_at, n_at, gold] -= 1
        d_move = np.zeros_like(move)
        for t in range(1, steps):
            d_move += np.exp(alpha[t - 1][:, :, None] + move + (e[t] + beta[t])[:, None, :] - total[:, None, None]).sum(0)
        np.subtract.at(d_move, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        score = e[t_at, n_at, gold].sum(0) + move[gold[:-1], gold[1:]].sum(0)
        grads = {"move": d_move / n, "out": np.einsum("tnh,tnk->hk", both, slope) / n, "out_b": slope.sum((0, 1)) / n}
        d_both = slope @ self.p["out"].T / n
        self._back(x, "f", held[0], d_both[:, :, : self.hidden], grads)
        self._back(x[:, ::-1], "b", held[1], d_both[::-1, :, self.hidden :], grads)
        return float((total - score).mean()), grads

    def _back(self, x, side, held, d_states, grads):
        h, w = self.hidden, self.p[f"h{side}"]
        d_state, d_cell = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
        g_x, g_h, g_b = np.zeros_like(self.p[f"x{side}"]), np.zeros_like(w), np.zeros(4 * h, np.float32)
        for t in range(len(held) - 1, -1, -1):
            state, cell, i, f, o, g, bent = held[t]
            d_state = d_state + d_states[t]
            d_cell = d_cell + d_state * o * (1 - bent * bent)
            dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * cell * f * (1 - f), d_state * bent * o * (1 - o),
                                 d_cell * i * (1 - g * g)], axis=1)
            np.add.at(g_x, x[:, t], dz)
            g_h += state.T @ dz
            g_b += dz.sum(0)
            d_state, d_cell = dz @ w.T, d_cell * f
        grads |= {f"x{side}": g_x, f"h{side}": g_h, f"b{side}": g_b}

    def fit(self, windows: list[tuple[str, list[Span]]], epochs: int = 10, batch: int = 32, rate: float = 0.02) -> Tagger:
        """Adam over windows of one length, in a fixed order of draws."""
        x = np.array([classes(t) for t, _ in windows])
        tags = np.array([tags_of(len(t), s) for t, s in windows])
        rng = np.random.default_rng(11)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        n = 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), -(-len(x) // batch)):
                n += 1
                for k, g in self.step(x[rows], tags[rows])[1].items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
        return self


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    best, came = scores[0], np.empty((len(scores), TAGS), np.int8)
    for t in range(1, len(scores)):
        paths = best[:, None] + move
        came[t] = paths.argmax(0)
        best = paths.max(0) + scores[t]
    tags = [int(best.argmax())]
    for t in range(len(scores) - 1, 0, -1):
        tags.append(int(came[t, tags[-1]]))
    return np.array(tags[::-1])


def spans_of(tags: np.ndarray) -> list[Span]:
    found, kind, start = [], None, 0
    for t, tag in enumerate([*tags.tolist(), 0]):
        inner = tag and tag % 2 == 0 and kind == KINDS[tag // 2 - 1]
        if kind and not inner:
            found.append((kind, start, t))
        if not inner:
            kind, start = (KINDS[(tag - 1) // 2], t) if tag else (None, t)
    return found


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and @, merged where they meet."""
    found: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.start() + MARGIN)
        if found and a <= found[-1][1]:
            found[-1] = found[-1][0], b
        else:
            found.append((a, b))
    return found


def network_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[Span]]:
    """Decoded spans of many texts; windows of all of them share batches."""
    places = [(k, a, b) for k, text in enumerate(texts) for a, b in regions(text)]
    found: list[list[Span]] = [[] for _ in texts]
    weight = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW))[:, None].astype(np.float32)
    held: list[tuple] = []

    def flush() -> None:
        x = np.zeros((len(held), WINDOW), np.int64)
        for row, (_, _, own) in zip(x, held):
            row[: len(own)] = own
        for (sums, at, own), scores in zip(held, tagger.scores(x)):
            sums[0][at : at + len(own)] += (scores * weight)[: len(own)]
            sums[1][at : at + len(own)] += weight[: len(own)]
        held.clear()

    open_regions: list[tuple] = []

    def close() -> None:
        flush()
        for k, a, sums in open_regions:
            found[k] += [(kind, a + s, a + e) for kind, s, e in spans_of(viterbi(sums[0] / sums[1], tagger.p["move"]))]
        open_regions.clear()

    for k, a, b in places:
        own = classes(texts[k][a:b])
        sums = np.zeros((b - a, TAGS), np.float32), np.zeros((b - a, 1), np.float32)
        open_regions.append((k, a, sums))
        for at in range(0, max(1, b - a - WINDOW // 2), WINDOW // 2):
            held.append((sums, at, own[at : at + WINDOW]))
            if len(held) >= batch:
                flush()
        if len(open_regions) >= batch:
            close()
    if open_regions:
        close()
    return found


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(spans of the patterns, those and the added ones) per text."""
    base = [base_spans(t) for t in texts]
    added = network_spans(texts, tagger) if tagger else [[] for _ in texts]
    result = []
    for text, own, more in zip(texts, base, added):
        starts, ends = sorted(a for _, a, _ in own), sorted(b for _, _, b in own)
        # A span touches none of those found where as many of them end up to its start as start before its end.
        free = [s for s in more if bisect.bisect_left(starts, s[2]) == bisect.bisect_right(ends, s[1])]
        result.append((own, own + [(kind, a, b) for kind, a, b in free if valid(kind, text[a:b])]))
    return result


def _windows_around(rows: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """Windows around labelled spans, at two places each."""
    found = []
    for text, spans in rows:
        for k, (kind, a, b) in enumerate(spans):
            if b - a > WINDOW - 8:
                continue
            for lead in (4 + 7 * k % 20, 24 + 5 * k % 20):
                start = max(0, min(a - min(lead, WINDOW - (b - a) - 2), len(text) - WINDOW))
                window = text[start : start + WINDOW].ljust(WINDOW)
                inside = [(q, x - start, y - start) for q, x, y in spans if x >= start and y <= start + WINDOW]
                cut_off = any(x < start < y or x < start + WINDOW < y for _, x, y in spans)
                if not cut_off:
                    found.append((window, inside))
    return found


def _windows_side_by_side(rows: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """Windows with two labelled values side by side."""
    found, values = [], [(kind, text[a:b]) for text, spans in rows for kind, a, b in spans if b - a <= WINDOW - 8]
    for (one, left), (two, right) in zip(values, values[len(values) // 2 :] + values[: len(values) // 2]):
        text = f"en {left} {right} de"
        a, b = 3, 4 + len(left)
        if len(text) <= WINDOW:
            found.append((text.ljust(WINDOW), [(one, a, a + len(left)), (two, b, b + len(right))]))
    return found


def _training_windows(rows: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    return _windows_around(rows) + _windows_side_by_side(rows)


def _drawn(windows: list[tuple[str, list[Span]]], pairs: list[tuple[str, list[Span]]], limit: int) -> list[tuple[str, list[Span]]]:
    """All windows of both sorts, or ``limit`` of them by hash: half of each sort, or more of one where the other has fewer."""
    if len(windows) + len(pairs) <= limit:
        return windows + pairs
    n_pairs = min(len(pairs), max(limit // 2, limit - len(windows)))
    by_hash = lambda part: sorted(part, key=lambda w: hashlib.blake2b(w[0].encode("utf-8", "replace"), digest_size=8).digest())
    return by_hash(windows)[: limit - n_pairs] + by_hash(pairs)[:n_pairs]


def train(docs: DataFrame, max_rows: int = 400, max_bytes: int = 100_000, max_windows: int = 2000) -> Tagger | None:
    """Fit on the spans the patterns find in ``max_rows`` texts with a digit or @, of at most ``max_bytes`` each.

    Rows are drawn by hash and id alone; only the texts of those drawn, each once, come to the driver. Where their windows are more than ``max_windows``, those around spans and those of values side by side are drawn evenly.
    """
    rows = id_and_bytes(docs).where(F.octet_length("text") <= max_bytes)
    rows = rows.where(F.col("text").cast("string").rlike("[0-9]{3}|@")).withColumn("draw", F.xxhash64("text"))
    drawn = sorted({r.draw for r in rows.select("draw", "doc_id").orderBy("draw", "doc_id").limit(max_rows).collect()})
    edge = drawn[-1] if drawn else None  # every row up to it is drawn, or is a copy of one that is
    chosen = rows.where(F.col("draw") <= F.lit(edge)).groupBy("draw").agg(F.first("text").alias("text")).orderBy("draw")
    labelled = [(t, base_spans(t)) for t in dict.fromkeys(decoded(bytes(r.text)) for r in chosen.collect())]
    labelled = [(t, s) for t, s in labelled if s]
    windows = _drawn(_windows_around(labelled), _windows_side_by_side(labelled), max_windows)
    return Tagger().fit(windows) if len(windows) >= 8 else None


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id, counts and digest of the patterns' spans, and all spans as ``kind:start:end`` in code points."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for part in rows for s in slices(part)):
            found = {f.name: [] for f in _FOUND}
            found["doc_id"] = batch.column("doc_id")
            for base, spans in all_spans([decoded(t.as_py()) for t in batch.column("text")], sent.value):
                for kind in KINDS:
                    found[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                found["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                found["spans"].append(joined(spans))
            yield batches(found, _FOUND)

    return id_and_bytes(docs).mapInArrow(released(run), _COLUMNS)


def masked(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with each value in ``text`` replaced by its kind in angle brackets; other columns and null texts stay."""
    sent, at = docs.sparkSession.sparkContext.broadcast(tagger), docs.columns.index("text")

    def hidden(text: str, spans: list[Span]) -> str:
        out, end = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= end:
                out += [text[end:a], f"<{kind}>"]
            end = max(end, b)
        return "".join([*out, text[end:]])

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(at).to_pylist()
            spans = all_spans([t or "" for t in texts], sent.value)
            new = pa.array([t if t is None else hidden(t, s) for t, (_, s) in zip(texts, spans)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    return docs.mapInArrow(released(run), docs.schema)
