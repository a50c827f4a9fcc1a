"""
Quality scores of texts by a linear model on Naive Bayes scaled n-gram indicators.

Each text is the set of its n-grams: three bytes in a row, words and pairs of words, hashed to a
fixed number of places, and how large a share of its pairs repeats one word. An indicator is scaled by the log ratio of
its share in the two classes, then a hinge-loss model is fitted by dual coordinate descent
(Wang and Manning, "Baselines and bigrams", 2012; Hsieh and others, "A dual coordinate descent
method for large-scale linear SVM", 2008). A sigmoid fitted on rows that the model has not seen
turns the margin into a score from 0 to 1.

The model is fitted in one task on at most SAMPLE labelled rows, those with the smallest hash of
their doc_id. Scoring is one scan of all texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.words import Words, fold, mix, stream, word_slices

SAMPLE = 4000
BITS = 16
# Shares of words equal to the one before; each that a text reaches is REPEAT_PLACES indicators,
# since a long text has thousands of others.
REPEATS = (0.01, 0.03, 0.1, 0.3, 0.6)
REPEAT_PLACES = 32
WIDTH = 2 * 2 ** BITS + len(REPEATS) * REPEAT_PLACES
DAMPING = 100                   # as many absent indicators damp the margin of a short text
SMOOTHING, COST, ROUNDS = 1.0, 1.0, 30
THRESHOLD = 0.7

_BYTES = stream(21, 3 * 256).reshape(3, 256)
_SHIFT = np.uint64(64 - BITS)


def indicators(words: Words) -> Iterator[np.ndarray]:
    """The places of the n-grams of each text, ascending, each once."""
    data, codes = words.data, words.codes
    if len(data) > 2:
        grams = mix(_BYTES[0][data[:-2]] ^ _BYTES[1][data[1:-1]] ^ _BYTES[2][data[2:]]) >> _SHIFT
    else:
        grams = np.zeros(0, np.uint64)
    base = np.uint64(2 ** BITS)
    single = (mix(codes) >> _SHIFT) + base
    pair = (fold(codes, np.arange(max(0, len(codes) - 1)), 2) >> _SHIFT) + base
    same = codes[1:] == codes[:-1]
    for t in range(len(words)):
        low, high = words.offsets[t], words.offsets[t + 1]
        first, end = words.first[t], words.first[t + 1]
        present = np.zeros(WIDTH, bool)
        present[grams[low:max(low, high - 2)]] = True
        present[single[first:end]] = True
        present[pair[first:max(first, end - 1)]] = True
        repeats = same[first:max(first, end - 1)]
        if len(repeats):
            reached = int((repeats.mean() >= np.array(REPEATS)).sum())
            present[2 * 2 ** BITS:2 * 2 ** BITS + reached * REPEAT_PLACES] = True
        yield np.flatnonzero(present)


@dataclass
class Model:
    weights: np.ndarray          # of every place, scaled by the log ratio
    bias: float
    slope: float
    shift: float

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[x].sum() / np.sqrt(len(x) + DAMPING) + self.bias
                         for x in rows])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.shift, -30, 30)))


def _log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.full((2, WIDTH), SMOOTHING)
    for x, y in zip(rows, good):
        counts[int(y), x] += 1
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def _coordinate_descent(rows: list[np.ndarray], ratios: np.ndarray,
                        sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on the scaled indicators, and the bias, that minimise the hinge loss."""
    weights, bias = np.zeros(WIDTH), 0.0
    values = [ratios[x] / np.sqrt(len(x) + DAMPING) for x in rows]
    squares = np.array([v @ v + 1 for v in values])
    # Both classes weigh the same in total.
    share = np.where(sign > 0, (sign > 0).mean(), (sign < 0).mean())
    most = COST / (2 * share)
    dual = np.zeros(len(rows))
    random = np.random.default_rng(5)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in random.permutation(len(rows)):
            slack = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slack / squares[i], 0.0), most[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def _sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with Platt's softened targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - target) + 1e-3 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """
    Fit on the indicators of some texts and their labels. With rows of one class only, or none,
    every text gets the smoothed share of good rows.
    """
    good = np.asarray(good, bool)
    if good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(WIDTH), 0.0, 1.0, float(np.log(share / (1 - share))))
    unseen = np.arange(len(rows)) % 5 == 4
    if len(set(good[unseen])) < 2 or len(set(good[~unseen])) < 2:
        unseen[:] = False
    seen = np.flatnonzero(~unseen)
    ratios = _log_ratios([rows[i] for i in seen], good[seen])
    weights, bias = _coordinate_descent([rows[i] for i in seen], ratios,
                                        np.where(good[seen], 1.0, -1.0))
    model = Model(weights * ratios, float(bias), 1.0, 0.0)
    rest = np.flatnonzero(unseen) if unseen.any() else seen
    model.slope, model.shift = _sigmoid(model.margins([rows[i] for i in rest]), good[rest])
    return model


def _indicator_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch.column("text")):
            places = [x.astype(np.uint32).tobytes() for x in indicators(words)]
            yield pa.record_batch({
                **{c: batch.column(c).slice(words.row, len(words)) for c in ("doc_id", "good")},
                "places": pa.array(places, pa.binary())})


def _fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, good, rows = [], [], []
    for batch in batches:
        ids += batch.column("doc_id").to_pylist()
        good += batch.column("good").to_pylist()
        rows += [np.frombuffer(x, np.uint32) for x in batch.column("places").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], good[i], rows[i].tobytes()))
    model = fit([rows[i] for i in order], np.array([good[i] for i in order], bool))
    yield pa.record_batch({
        "weights": pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
        "bias": [model.bias], "slope": [model.slope], "shift": [model.shift]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """
    A model from docs (doc_id, text) and labels (doc_id, good boolean).

    At most `sample` labels are taken, by the smallest hash of doc_id; rows without id or label
    are left out. Of the rows of a repeated doc_id the text with the smallest hash is taken, so that
    no more rows than labels are fitted, however often an id occurs.
    """
    chosen = labels.where("doc_id is not null and good is not null") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "good") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # `sample` rows of an id and a flag at most are broadcast.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good") \
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")) \
        .mapInArrow(_indicator_rows, "doc_id long, good boolean, places binary")
    found = rows.repartition(1).mapInArrow(
        _fit_all, "weights binary, bias double, slope double, shift double").first()
    if found is None:
        return fit([], np.zeros(0, bool))
    return Model(np.frombuffer(found["weights"], np.float32).astype(float), found["bias"],
                 found["slope"], found["shift"])


def score(text: Column, model: Model) -> Column:
    """The score of a text column, 0 to 1; a null is an empty text, which scores by the bias."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.scores(list(indicators(words))) for words in word_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))
    return scored(text)
