"""Toxicity: a counterfactual-regularised classifier, trained in numpy, applied to whole texts.

A text is the set of its words (lower-cased, without punctuation at the ends) and of their runs of three and four
characters, hashed to ``1 << BITS`` features; the score is logistic. Fitting minimises the weighted log loss, an L1 term
that zeroes the weights of features without a signal, and the mean squared change of the logit when identity terms are
swapped: for each training text, the first line that names a group is taken with the term replaced by another; where no
line names one, one term is put in another's place. A group named in toxic texts by chance so cannot gain a weight that
another has not; the mean weight of the terms is penalised too, as naming a group at all should not move the score.

Training reads at most ``max_rows`` labelled rows (those with the smallest hash of text and id, whatever their label), as
features, on the driver, and fits the ``kept`` features that tell the labels apart best (chi-square over those rows);
scoring reads every row and word. Rows whose crc32(doc_id) mod 5 is 0 are never trained on.

Defined results: empty and null texts score the bias alone; a null doc_id is not held out; null labels are not used;
repeated rows and labels count as often as they occur; without both labels present the score is near the share of label 1
(0.5 with no labels); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import Remembered, batches, decoded, id_and_bytes, released, slices

BITS = 20
EDGES = ".,;:!?\"'()[]{}<>*_-"

# Neutral words that name groups of people.
IDENTITY_TERMS = (
    "women men girls boys gay lesbian straight transgender muslims christians jews hindus buddhists atheists black white "
    "asian african european latino immigrants refugees natives disabled blind deaf old young "
    "mujeres hombres musulmanes cristianos judíos negros blancos inmigrantes "
    "femmes hommes musulmans chrétiens juifs noirs blancs immigrés "
    "frauen männer muslime christen juden schwarze weiße einwanderer"
).split()

_FEATURES = pa.schema([("label", pa.int32()), ("copies", pa.int64()), ("words", pa.list_(pa.int32())), ("less", pa.list_(pa.int32())),
                       ("more", pa.list_(pa.int32()))])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def features(word: str) -> tuple[int, ...]:
    """The features of a lower-cased word as it stands in a text."""
    word = word.strip(EDGES)
    grams = {word[i : i + n] for n in (3, 4) for i in range(len(word) - n + 1)}
    return tuple({xxhash.xxh3_64_intdigest(g) & ((1 << BITS) - 1) for g in ({f"{word} ", *grams} if word else ())})


def features_of(text: str, known: Remembered) -> set[int]:
    return set().union(*map(known.__getitem__, set(text.lower().split())))


def counterfactual(text: str, terms: list[str], known: Remembered) -> tuple[set[int], set[int]]:
    """Features that the first line with an identity term loses and gains when the term is swapped for another."""
    draw = xxhash.xxh3_64_intdigest(text)
    step = 1 + (draw >> 20) % (len(terms) - 1)
    for line in text.lower().splitlines():
        words = line.split()
        named = next((k for k, w in enumerate(words) if w.strip(EDGES) in terms), None)
        if named is not None:
            rest = set().union(*map(known.__getitem__, words[:named] + words[named + 1 :]))
            other = terms[(terms.index(words[named].strip(EDGES)) + step) % len(terms)]
            old, new = set(known[words[named]]) - rest, set(known[other]) - rest
            return old - new, new - old
    old, new = set(known[terms[draw % len(terms)]]), set(known[terms[(draw + step) % len(terms)]])
    return old - new, new - old


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray

    def used(self) -> dict[int, float]:
        at = np.flatnonzero(self.weights)
        return dict(zip(at.tolist(), self.weights[at].tolist()))

    def score(self, text: str) -> float:
        return Scorer(self.bias, self.used()).score(text)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sparse:
    """Rows of feature numbers; empty rows are allowed."""

    def __init__(self, rows: list, width: int = 1 << BITS):
        self.rows, self.width = len(rows), width
        self.columns = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.empty(0, np.int32)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])

    def renumbered(self, number: np.ndarray, width: int) -> Sparse:
        """Only the features that have a number."""
        part, columns = Sparse([], width), number[self.columns]
        part.rows, part.columns, part.row = self.rows, columns[columns >= 0], self.row[columns >= 0]
        return part

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.columns], self.rows)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, values[self.row], self.width)


def telling(x: Sparse, labels: np.ndarray, kept: int, least: int = 3) -> np.ndarray:
    """The features, in ``least`` rows or more, that tell the labels apart best by chi-square."""
    n, positive = len(labels), labels.sum()
    both, hits = x.back(np.ones(n)), x.back(labels.astype(float))
    expected = both * positive / n
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (hits - expected) ** 2 * n * n / (both * (n - both) * positive * (n - positive) / n)
    score = np.where((both >= least) & np.isfinite(score), score, 0)
    order = np.argsort(-score, kind="stable")[:kept]
    return np.sort(order[score[order] > 0])


def fit(labels: np.ndarray, words: list, less: list, more: list, steps: int = 300, l1: float = 1e-4, kept: int = 512,
        swap_weight: float = 1.0, terms: tuple[str, ...] = tuple(IDENTITY_TERMS)) -> Model:
    """Proximal Adagrad on the whole training set."""
    fitted, positive = np.zeros(1 << BITS), float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < positive < 1:
        return Model(float(np.log((positive + 1e-3) / (1 - positive + 1e-3))), fitted)
    x, x_less, x_more = Sparse(words), Sparse(less), Sparse(more)
    chosen = telling(x, labels, kept)
    number = np.full(1 << BITS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    x, x_less, x_more = (part.renumbered(number, len(chosen)) for part in (x, x_less, x_more))
    named = number[sorted({f for t in terms for f in features(t)})]
    named, weights = named[named >= 0], np.zeros(len(chosen))
    cost = np.where(labels == 1, 0.5 / positive, 0.5 / (1 - positive)) / len(labels)
    bias, bias_seen, seen = 0.0, 1e-8, np.full(len(chosen), 1e-8)
    for _ in range(steps):
        error = cost * (sigmoid(bias + x.times(weights)) - labels)
        change = (x_more.times(weights) - x_less.times(weights)) * (2 * swap_weight / len(labels))
        slope = x.back(error) + x_more.back(change) - x_less.back(change)
        if len(named):
            slope[named] += 2 * swap_weight * weights[named].mean() / len(named)
        seen += slope * slope
        bias_seen += error.sum() ** 2
        rate = 0.5 / np.sqrt(seen)
        weights -= rate * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * l1, 0)
        bias -= 0.5 * error.sum() / np.sqrt(bias_seen)
    fitted[chosen] = weights
    return Model(bias, fitted)


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 3_000, **options) -> Model:
    """Fit on the labelled rows of ``docs`` that are not held out, at most ``max_rows`` of them."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(features, 100_000)
        for batch in (s for part in rows for s in slices(part)):
            texts = [decoded(t.as_py()) for t in batch.column("text")]
            swaps = [counterfactual(t, IDENTITY_TERMS, known) for t in texts]
            columns = {"label": batch.column("label"), "copies": batch.column("copies"),
                       "words": [sorted(features_of(t, known)) for t in texts], "less": [sorted(a) for a, _ in swaps], "more": [sorted(b) for _, b in swaps]}
            yield batches(columns, _FEATURES)

    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    marked = marked.where(F.col("label").isin(0, 1) & (remainder(F.col("doc_id")) != 0))
    rows = id_and_bytes(docs).withColumn("draw", F.xxhash64("text", "doc_id"))
    # Repeated rows and labels are counted before they meet, and a repeated row brings its text once.
    own = rows.groupBy("doc_id", "draw").agg(F.count("*").alias("n_rows"))
    twice = marked.groupBy("doc_id", "label").agg(F.count("*").alias("n_labels"))
    lowest = own.join(twice, "doc_id").select("draw", "doc_id", "label", (F.col("n_rows") * F.col("n_labels")).alias("copies"))
    wanted, left = [], max_rows
    for draw, doc_id, label, copies in lowest.orderBy("draw", "doc_id", "label").limit(max_rows).collect():
        if left:
            wanted.append((draw, doc_id, label, min(copies, left)))
            left -= wanted[-1][3]
    edge = max((w[0] for w in wanted), default=None)  # the bound as a filter: texts of other rows are never moved
    wanted = docs.sparkSession.createDataFrame(wanted, "draw long, doc_id long, label int, copies long")
    texts = rows.where(F.col("draw") <= F.lit(edge)).join(F.broadcast(wanted.select("draw", "doc_id").distinct()), ["draw", "doc_id"])
    texts = texts.groupBy("draw", "doc_id").agg(F.first("text").alias("text"))
    chosen = texts.join(F.broadcast(wanted), ["draw", "doc_id"]).select("label", "copies", "text")
    schema = "label int, copies long, words array<int>, less array<int>, more array<int>"
    found = chosen.mapInArrow(released(run), schema).toArrow().to_pandas()
    if not len(found):
        return fit(np.empty(0), [], [], [], **options)
    # The rows come in any order: sort them, so that sums and so weights are the same in every run.
    columns = {c: found[c].to_list() for c in ("words", "less", "more")}  # arrays, not lists of numbers
    order = sorted(range(len(found)), key=lambda k: (found["label"][k], columns["words"][k].tobytes(), columns["less"][k].tobytes()))
    order = np.repeat(order, found["copies"].to_numpy()[order])  # the lists of a repeated row are held once
    return fit(found["label"].to_numpy()[order], *([columns[c][k] for k in order] for c in columns), **options)


class Scorer:
    """Scores of texts from the bias and the weights that are not zero."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights
        # Not a method: the values would hold the scorer and the scorer them, and stay when a task is done.
        self.known = Remembered(lambda word: tuple(f for f in features(word) if f in weights))

    def score(self, text: str) -> float:
        return float(sigmoid(self.bias + sum(self.weights[f] for f in sorted(features_of(text, self.known)))))


def _sent(docs: DataFrame, model: Model):
    """The model for the tasks; L1 leaves few weights, and their number is bounded by the width of the table."""
    return docs.sparkSession.sparkContext.broadcast((model.bias, model.used()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    sent = _sent(docs, model)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in rows:
            found = [scorer.score(decoded(t.as_py())) for t in batch.column("text")]
            yield batches({"doc_id": batch.column("doc_id"), "score": found}, _SCORES)

    scored = id_and_bytes(docs).mapInArrow(released(run), "doc_id long, score double")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, with their columns as they are."""
    sent, at = _sent(docs, model), docs.columns.index("text")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in rows:
            keep = [scorer.score(t.as_py() or "") < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
